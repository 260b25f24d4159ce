"""Market price bars on Spark: ingest, upsert, features, models and scores.

The symbol is a key column everywhere, so one Spark job serves every symbol.
"""
