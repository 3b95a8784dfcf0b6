"""nightledger: a daily banking warehouse load and fraud report on Spark.

Staging readers, SCD1/SCD2 dimension maintenance, append-only facts, an
enriched transaction table and four fraud rules, each a DataFrame operator.
"""

__version__ = "0.1.0"
