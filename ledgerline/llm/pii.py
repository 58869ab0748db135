"""Personal data: fixed patterns, and contexts learned from what they find.

Base spans come from four patterns, leftmost non-overlapping per kind. Positions follow
from the lengths of the matches and of the text between them, in code points.

The method then bootstraps. Instances are the base spans (the seeds) and every other
token with an ``@`` or at least ``min_digits`` digits, by their string; groups of digits that
follow a token with digits after one blank each belong to it (numbers written in groups).
Patterns are the word to the left and the word to the right of an instance (lower-cased;
very long words by their hash). Both form a graph, whose edges carry the number of
occurrences over all documents. Seeds score 1, other instances 0 at first. In each round

* a pattern's confidence is the mean score of its instances, occurrences counted at most
  ``MOST_OF_ONE`` times, times the share of the word's occurrences in the whole corpus that stand
  beside an instance (a word that is everywhere proves nothing), if at least ``min_seeds``
  different seeds have it, else 0. The border of a text is no word and proves nothing;
* a new instance's score is 1 - (1 - l)(1 - r), taken over its left and right patterns
  (the mean confidence on each side).

After ``rounds`` rounds an occurrence that is no base span is found if the pattern on one of
its sides has ``accept`` confidence or more, or if its instance has such a score, proven by
its other occurrences. It is reported as kind ``context``. Base spans stay as they are.

Null texts count as empty. Rows that repeat id and text are one document for the graph
and have equal results. An empty table gives an empty result. All steps are
DataFrame operations; only the id and the text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, keyed

KINDS = ("email", "ip", "card", "phone", "context")

# The patterns of the base kinds, with possessive repeats, and begun only where
# a run begins or the last match ended: the same matches, in linear time on long runs.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

SPACE = r"\x20\x09-\x0D"
GROUP = r"[0-9()+./-]*[0-9][0-9()+./-]*"
TOKEN = rf"(?<![^{SPACE}])[^{SPACE}0-9@]*+(?:[0-9][^{SPACE}@]*+(?![^{SPACE}])(?:\x20(?:{GROUP})(?![^{SPACE}]))*+|[0-9@][^{SPACE}]*+)"
LONG = 64  # characters of the longest word that is a pattern by itself
CHUNK = 256
MOST_OF_ONE = 3
SPAN = "struct<start: bigint, kind: int, `end`: bigint, left: string, right: string, form: string>"


def _running(steps: Column, add=lambda a, b: a + b) -> Column:
    """Sums (or what ``add`` does, from 0) of all that stands before each item; in chunks, so that long arrays stay cheap."""

    def before(a: Column, value) -> Column:
        return F.aggregate(a, F.array(F.lit(0).cast("bigint")), lambda acc, x: F.concat(acc, F.array(add(F.element_at(acc, -1), value(x)))))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / CHUNK).cast("int")), lambda c: F.slice(steps, c * CHUNK + 1, CHUNK))
    inner = F.transform(chunks, lambda c: before(c, lambda x: x))
    offsets = before(inner, lambda c: F.element_at(c, -1))
    return F.flatten(F.zip_with(inner, F.slice(offsets, F.lit(1), F.size(inner)), lambda c, o: F.transform(F.slice(c, F.lit(1), F.size(c) - 1), lambda x: add(x, o))))


def _word(gap: Column, which: int) -> Column:
    """The first (1) or last (-1) word of a gap, all of it."""
    return _named(F.substring_index(_flat(gap), " ", which))


def _matches(text: str, pattern: str, kind: int, good, maybe: Column) -> Column:
    """Array of spans of the matches that ``good`` accepts; ``maybe``: a cheap test whether there can be any."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    # named once, so that each is computed once
    both = F.transform(F.array(F.struct(found.alias("m"), gaps.alias("g"))), lambda x: F.struct(
        x["m"].alias("m"), x["g"].alias("g"),
        F.when(F.size(x["m"]) > 0, _running(F.zip_with(x["m"], F.slice(x["g"], F.lit(1), F.size(x["m"])), lambda m, g: (F.char_length(m) + F.char_length(g)).cast("bigint")))).alias("s"),
    ))

    def spans(x: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            start = F.get(x["s"], i) + F.char_length(F.get(x["g"], i))
            return F.struct(
                start.alias("start"), F.lit(kind).alias("kind"), (start + F.char_length(m)).alias("end"),
                _word(F.get(x["g"], i), -1).alias("left"), _word(F.get(x["g"], i + 1), 1).alias("right"), m.alias("form"),
            )

        return F.filter(F.transform(x["m"], one), lambda s: good(s["form"]))

    return F.when(maybe, F.flatten(F.transform(both, spans))).otherwise(F.array()).cast(f"array<{SPAN}>")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _card(m: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(F.lit(False))


def base_spans(text: str) -> Column:
    """All base spans of a text column, by start, then kind."""
    parts = [
        _matches(text, EMAIL, 0, lambda m: F.lit(True), F.contains(F.col(text), F.lit("@"))),
        _matches(text, IP, 1, lambda m: F.forall(F.split(m, "\\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$")), F.col(text).rlike("[0-9]\\.[0-9]")),
        _matches(text, CARD, 2, _card, F.col(text).rlike("[0-9][\\x20-]?[0-9]")),
        _matches(text, PHONE, 3, lambda m: F.length(_digits(m)).between(10, 15), F.contains(F.col(text), F.lit("+"))),
    ]
    return F.sort_array(F.concat(*parts))


def _found(rows: DataFrame, min_digits: int) -> DataFrame:
    """(_id, _h, base, others): base spans, and the other identifier-like tokens that touch none of them."""
    token = _matches("_text", TOKEN, 4, lambda m: F.contains(m, F.lit("@")) | (F.length(_digits(m)) >= min_digits), F.col("_text").rlike("[0-9@]"))
    spans = rows.select("_id", "_h", base_spans("_text").alias("base"), token.alias("tokens"))
    return spans.select("_id", "_h", "base", F.when(F.size("tokens") > 0, _apart("tokens", "base")).otherwise(F.col("tokens")).alias("others"))


def _apart(tokens: str, base: str) -> Column:
    """Tokens that touch no base span: in one order of token ends and base starts, the farthest base end so far stays before the token."""
    none = F.lit(None).cast(SPAN)
    begun = F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("b"), b["end"].alias("to"), none.alias("t")))
    ended = F.transform(tokens, lambda t: F.struct(t["end"].alias("at"), F.lit(0).alias("b"), F.lit(0).cast("bigint").alias("to"), t.alias("t")))
    both = F.transform(F.array(F.sort_array(F.concat(begun, ended))), lambda e: F.struct(e.alias("e"), _running(F.transform(e, lambda x: x["to"]), F.greatest).alias("r")))
    free = F.transform(both, lambda x: F.filter(F.transform(x["e"], lambda e, i: F.when((e["b"] == 0) & (F.get(x["r"], i) <= e["t"]["start"]), e["t"])), lambda t: t.isNotNull()))
    return F.flatten(free)


def _flat(text: Column) -> Column:
    return F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     "))


def _named(word: Column) -> Column:
    """A lower-cased word as a pattern; very long ones by their hash."""
    word = F.lower(word)
    return F.when(F.char_length(word) > LONG, F.concat(F.lit("# "), F.sha2(word.cast("binary"), 256))).otherwise(word)


def _edges(found: DataFrame) -> DataFrame:
    """(pattern, form, seed, n, times): how often a pattern stands beside an instance, n counted up to a limit.

    Rows of one document are equal in all columns, so that hashing finds them without a sort; they
    are one document for n, and count all for ``times``, as they do in the counts of words.
    """
    spans = found.groupBy(*found.columns).agg(F.count("*").alias("rows")).select("rows", F.explode(F.concat("base", "others")).alias("s"))
    each = spans.select(
        "rows",
        F.explode(F.array(F.concat(F.lit("L "), "s.left"), F.concat(F.lit("R "), "s.right"))).alias("pattern"),
        F.lower("s.form").alias("form"),
        (F.col("s.kind") < 4).alias("seed"),
    )
    return each.groupBy("pattern", "form").agg(F.max("seed").alias("seed"), F.least(F.count("*"), F.lit(MOST_OF_ONE)).alias("n"), F.sum("rows").alias("times"))


def _counts(rows: DataFrame) -> DataFrame:
    """(word, total) over all rows; words are counted where they are before anything is shuffled."""
    word = F.explode(F.split(_flat(F.col("_text")), " +"))
    return rows.select(word.alias("word")).groupBy(_named(F.col("word")).alias("word")).agg(F.count("*").alias("total"))


def learn(rows: DataFrame, found: DataFrame, scratch: Scratch, rounds: int = 3, min_seeds: int = 3) -> tuple[DataFrame, DataFrame]:
    """(pattern, confidence) and (form, score) of the new instances, after ``rounds`` rounds over the graph."""
    edges = scratch.save(_edges(found), "edges")
    seeds = edges.groupBy("pattern").agg(F.count_if("seed").alias("seeds"), F.sum("times").alias("times")).filter((F.col("seeds") >= min_seeds) & (F.length("pattern") > 2))
    word = F.substr("pattern", F.lit(3))
    special = F.col("times") / F.greatest("times", F.coalesce("total", F.lit(0)))
    seeds = scratch.save(seeds.withColumn("word", word).join(_counts(rows), "word", "left").select("pattern", special.alias("special")), "seeds")
    scores = None
    for n in range(rounds):
        scored = edges.withColumn("score", F.col("seed").cast("double")) if scores is None else (
            edges.join(scores, "form", "left").withColumn("score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("score", F.lit(0.0))))
        )
        # sums of scores in millionths are whole numbers: the order of adding doesn't matter
        mean = scored.groupBy("pattern").agg((F.sum(F.round(F.col("score") * 1000000).cast("long") * F.col("n")) / F.sum("n") / 1000000).alias("mean"))
        confidence = mean.join(seeds, "pattern", "left").select("pattern", F.coalesce(F.col("mean") * F.col("special"), F.lit(0.0)).alias("confidence"))
        confidence = scratch.save(confidence, f"patterns{n}")
        new = edges.filter(~F.col("seed")).join(confidence, "pattern")
        side = F.col("pattern").startswith("L ")

        def mean_of(which: Column) -> Column:
            total = F.sum(F.when(which, F.round(F.col("confidence") * 1000000).cast("long") * F.col("n")))
            return F.coalesce(total / F.sum(F.when(which, F.col("n"))) / 1000000, F.lit(0.0))

        scores = new.groupBy("form").agg(mean_of(side).alias("l"), mean_of(~side).alias("r")).select("form", (1 - (1 - F.col("l")) * (1 - F.col("r"))).alias("score"))
        scores = scratch.save(scores, f"instances{n}")
    return confidence, scores


def extract(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_digits: int = 5,
    rounds: int = 3,
    min_seeds: int = 3,
    accept: float = 0.8,
) -> DataFrame:
    """(doc_id, base, spans): arrays of (start, kind number, end) by start, then kind."""
    scratch = Scratch(docs.sparkSession)
    rows = keyed(docs, doc_id, text)
    found = scratch.save(_found(rows, min_digits), "found")
    confidence, scores = learn(rows, found, scratch, rounds, min_seeds)
    sure = confidence.filter(F.col("confidence") >= accept).select("pattern")
    proven = scores.filter(F.col("score") >= accept).select("form", F.lit(True).alias("by_form"))
    places = found.select("_id", "_h", "others").distinct().select("_id", "_h", F.explode("others").alias("s"))
    flat = places.select("_id", "_h", "s.start", "s.kind", "s.end", "s.left", "s.right", F.lower("s.form").alias("form"))
    for which, mark in (("left", "L "), ("right", "R ")):
        own = sure.filter(F.col("pattern").startswith(mark)).select(F.substr("pattern", F.lit(3)).alias(which), F.lit(True).alias(f"by_{which}"))
        flat = flat.join(own, which, "left")
    kept = flat.join(proven, "form", "left").filter(F.coalesce("by_left", "by_right", "by_form"))
    more = kept.groupBy("_id", "_h").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("more"))
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    joined = found.alias("f").join(more.alias("m"), F.expr("f._id <=> m._id and f._h = m._h"), "left")
    out = joined.select(F.col("f._id").alias("doc_id"), plain.alias("base"), "more")
    both = F.sort_array(F.concat("base", F.coalesce("more", F.array().cast("array<struct<start: bigint, kind: int, end: bigint>>"))))
    return out.select("doc_id", "base", both.alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
