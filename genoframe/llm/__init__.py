"""Training-data operators: near-duplicates, fingerprints, toxicity, tokens, leaks, repeats, counts, chats, URLs, shards.

Nothing outside this subpackage imports it.  Operators take DataFrames and
return DataFrames; working tables go to the shared folder in
``spark.checkpoint.dir`` so that a lost executor costs only its own tasks.
"""
