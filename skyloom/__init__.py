"""skyloom: reorganise row-aligned sky catalogues with Spark.

Sources are numbered and joined by position, split into equal-population
ranges of one key, ordered by hierarchical sky pixel and published with an
index, provenance and checks.  Every step is a DataFrame plan.
"""
