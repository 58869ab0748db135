"""Name search, query audit and chat history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import text as T

PROJECT, CLIENT = "projeto", "cliente"


def resolve_names(names: DataFrame, question: str, k: int = 10) -> DataFrame:
    """Projects and clients a question may mean.

    Names that contain all of the first four search words, ten per kind; if
    there are none, names that contain either of the first two long words, five
    per kind and word. The words are constants of one scan: each name lists the
    rules it meets, and the best names per rule are kept before anything is
    shuffled.
    """
    words = T.question_tokens(question)
    if not words:
        return names.select("nome", "tipo").limit(0)
    long = [w for w in words if len(w) > 3][:2]
    rules = [words[:4]] + ([[w] for w in long] if long and long != words else [])
    met = F.array_compact(F.array(*[F.when(T.contains_all("nome", r), F.lit(i)) for i, r in enumerate(rules)]))
    hits = names.select("nome", "tipo", F.explode(met).alias("regra")).distinct()
    first = Window.partitionBy("regra", "tipo").orderBy("nome")
    hits = hits.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= 10)
    hits = hits.filter((F.col("regra") == 0) | (F.col("_n") <= 5))
    # from here on at most 10 + 2 x 5 names per kind
    stage = F.when(F.col("regra") == 0, 0).otherwise(1)
    best = hits.withColumn("_best", F.min(stage).over(Window.partitionBy())).filter(stage == F.col("_best"))
    kind = F.when(F.col("tipo") == PROJECT, 0).otherwise(1)
    one = best.groupBy("nome").agg(F.min_by("tipo", kind).alias("tipo"))
    return one.orderBy(F.when(F.col("tipo") == PROJECT, 0).otherwise(1), "nome").limit(k)


GRAM = 3


def _grams(text: Column) -> Column:
    """Distinct pieces of up to three characters: of that length, and shorter ones for short words."""
    pieces = lambda n: F.when(
        F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substr(text, i, F.lit(n)))
    ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*[pieces(n) for n in range(1, GRAM + 1)]))


def resolve_questions(names: DataFrame, questions: DataFrame, k: int = 10) -> DataFrame:
    """``resolve_names`` for a table of questions (pergunta, texto): pergunta, nome, tipo, posicao.

    Names are indexed by their three-character pieces. A rule (the first four words, or one long
    word) looks itself up by one piece, the one of its words that fewest names have, in an
    equality join; ``contains`` decides on the candidates. Equal rules of different questions are
    looked up once, and only the first ten names per rule and kind go on.
    """
    names = names.select("nome", "tipo").filter(F.col("nome").isNotNull()).distinct()
    words = questions.select("pergunta", T.tokens("texto").alias("w")).filter(F.size("w") > 0)
    long = F.slice(F.filter("w", lambda w: F.length(w) > 3), 1, 2)
    rule = lambda n, w: F.struct(F.lit(n).alias("regra"), w.alias("palavras"))
    singles = F.transform(long, lambda w, i: F.struct((i + 1).alias("regra"), F.array(w).alias("palavras")))
    no_more = F.array().cast("array<struct<regra:int,palavras:array<string>>>")
    rules = F.concat(F.array(rule(0, F.slice("w", 1, 4))), F.when(long != F.col("w"), singles).otherwise(no_more))
    rules = words.select("pergunta", F.explode(rules).alias("r")).select("pergunta", "r.regra", "r.palavras")

    index = names.select("nome", "tipo", F.explode(_grams(F.lower("nome"))).alias("g"))
    spread = index.groupBy("g").agg(F.count("*").alias("n"))
    # a word's pieces as long as its length allows, at most three characters
    of_word = lambda w: F.filter(_grams(w), lambda g: F.length(g) == F.least(F.length(w), F.lit(GRAM)))
    sets = rules.select("palavras").distinct()
    pieces = sets.select("palavras", F.explode(F.array_distinct(F.flatten(F.transform("palavras", of_word)))).alias("g"))
    rarest = pieces.join(spread, "g", "left").groupBy("palavras").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g")).alias("m"))
    found = (
        rarest.filter("m.n > 0")
        .select("palavras", F.col("m.g").alias("g"))
        .join(index, "g")
        .filter(F.forall("palavras", lambda w: F.contains(F.lower("nome"), w)))
    )
    first = Window.partitionBy("palavras", "tipo").orderBy("nome")
    found = found.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= 10).drop("g")
    hits = rules.join(found, "palavras").filter((F.col("regra") == 0) | (F.col("_n") <= 5))
    # from here on at most 10 + 2 x 5 names per kind and question
    fallback = F.col("regra") > 0
    kind = F.when(F.col("tipo") == PROJECT, 0).otherwise(1)
    best = hits.withColumn("_all", F.bool_or(~fallback).over(Window.partitionBy("pergunta"))).filter(~fallback | ~F.col("_all"))
    one = best.groupBy("pergunta", "nome").agg(F.min_by("tipo", kind).alias("tipo"))
    place = F.row_number().over(Window.partitionBy("pergunta").orderBy(kind, "nome"))
    return one.select("pergunta", "nome", "tipo", place.cast("long").alias("posicao")).filter(F.col("posicao") <= k)


def search_names(df: DataFrame, col: str, q: str, k: int = 20) -> DataFrame:
    """Rows whose name contains the text, by name."""
    hits = df if not q.strip() else df.filter(F.lower(col).contains(q.lower().strip()))
    return hits.orderBy(*[c for c in (col, *[x for x in df.columns if x != col])]).limit(k)


def audit_queries(log: DataFrame, dataset: str) -> DataFrame:
    """Whether each logged query (``sql``, ``is_exec``) was allowed, and the first rule it broke.

    ``estrito`` also catches banned words that touch punctuation.
    """
    text = F.trim(F.coalesce("sql", F.lit("")))
    upper = F.upper(text)
    banned = F.array(*[F.lit(w) for w in K.BANNED_SQL_WORDS])
    words = F.split(upper, r"\s+")
    restricted = reduce(lambda a, b: a | b, [F.lower(text).contains(t) for t in K.RESTRICTED_TABLES])
    reason = (
        F.when(~upper.startswith("SELECT"), "not_select")
        .when(F.arrays_overlap(words, banned), "banned_word")
        .when(~text.contains(dataset), "foreign_dataset")
        .when(restricted & ~F.coalesce("is_exec", F.lit(False)), "restricted_table")
    )
    touching = upper.rlike(r"\b(" + "|".join(K.BANNED_SQL_WORDS) + r")\b")
    return log.withColumn("motivo", F.coalesce(reason, F.lit(""))).select(
        "*", (F.col("motivo") == "").alias("permitido"), ((F.col("motivo") == "") & ~touching).alias("estrito")
    )


def last_messages(messages: DataFrame, n: int = 10, chars: int = 500) -> DataFrame:
    """Last n messages per chat with the text cut; at most n rows per chat and task are shuffled."""
    w = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    cut = F.substring("text", 1, chars)
    return (
        messages.select("conv_id", "turn", "role", cut.alias("text"))
        .withColumn("_n", F.row_number().over(w))
        .filter(F.col("_n") <= n)
        .drop("_n")
    )
