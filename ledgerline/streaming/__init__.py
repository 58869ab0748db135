"""The same questions asked continuously: admission control, history, merges, run health."""
