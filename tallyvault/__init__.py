"""tallyvault: a Spark-native daily ledger pipeline.

Staging slices of money transfers and exchange rates are loaded into a
Data Vault (hubs, links, satellites keyed by portable hashes) and rolled
up into a per-day, per-currency metrics mart.  Everything is expressed as
DataFrame transformations so Catalyst plans the joins and aggregations.
"""

__all__ = ["session", "schemas"]
