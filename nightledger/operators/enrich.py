"""The enriched transaction table the fraud rules read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import full_name
from ..schemas import ENRICHED_COLUMNS

BLACKLISTED = "passport_blacklisted"


def blacklisted_passports(blacklist: DataFrame) -> DataFrame:
    """Distinct non-null blacklisted passports with a ``True`` marker."""
    return (blacklist.select("passport_num").where(F.col("passport_num").isNotNull())
            .distinct().withColumn(BLACKLISTED, F.lit(True)))


def client_profile(clients: DataFrame, blacklist: DataFrame | None = None) -> DataFrame:
    """Client attributes the report needs, one row per client.

    When a blacklist is given the flag is attached here, on the client
    dimension, so that the passport rule later is a plain filter over the
    transactions instead of a second join of the (much larger) fact side.
    """
    c = clients.select("client_id", "passport_num", "passport_valid_to",
                       full_name().alias("fio"), "phone")
    if blacklist is None:
        return c
    return (c.join(blacklisted_passports(blacklist), "passport_num", "left")
             .withColumn(BLACKLISTED, F.coalesce(F.col(BLACKLISTED), F.lit(False))))


def card_profile(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                 blacklist: DataFrame | None = None) -> DataFrame:
    """cards -> accounts -> clients, joined on the dimension side first.

    The result has one row per card, so the fact table is joined (and
    shuffled) once for all three dimensions instead of three times.
    """
    acc = accounts.select("account_num", "valid_to", F.col("client").alias("client_id"))
    return (cards.select("card_num", "account_num")
            .join(acc, "account_num", "inner")
            .join(client_profile(clients, blacklist), "client_id", "inner"))


def enrich(fact: DataFrame, cards: DataFrame, terminals: DataFrame,
           accounts: DataFrame, clients: DataFrame,
           blacklist: DataFrame | None = None, profile: DataFrame | None = None) -> DataFrame:
    """Inner-join every transaction to its card, account, client and terminal.

    Output: the 12 enriched columns (plus ``passport_blacklisted`` when a
    blacklist is given).  Transactions whose card, account, client or
    terminal is missing drop out, as with the inner joins of the original.
    ``profile``: the ``card_profile`` of these tables, if at hand.
    """
    f = fact.select("trans_id", "trans_date", "amt", "oper_result", "card_num",
                    F.col("terminal").alias("terminal_id"))
    term = terminals.select("terminal_id", "terminal_city")
    profile = card_profile(cards, accounts, clients, blacklist) if profile is None else profile
    out = (f.join(profile, "card_num", "inner")
            .join(term, "terminal_id", "inner"))
    cols = ENRICHED_COLUMNS + ([BLACKLISTED] if blacklist is not None else [])
    return out.select(*cols)
