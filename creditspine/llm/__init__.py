"""Training-data operators: search, duplicates, filters, packing, mixing, tokens.

Nothing outside this folder imports it. Queries and their SQL are in
``queries``; ``corpus_pipeline.py`` at the repository top chains five stages.
"""
