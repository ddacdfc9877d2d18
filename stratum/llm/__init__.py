"""Training-data operators: near-duplicates, packing, token counts, repeated
substrings, sharding, quality rules, pseudonyms, language-model scores,
benchmark decontamination and a quality classifier.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
when it is present.
"""
