"""Column clean-up of raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import clean_name

# Canonical column name -> accepted spellings, in order of preference.
COLUMN_ALIASES = {
    "transaction_id": ["transaction_id", "transactionid", "txn_id", "id"],
    "account_number": ["account_number", "accountnumber", "account_no", "acc_no"],
    "transaction_date": ["transaction_date", "date", "txn_date", "trans_date"],
    "transaction_type": ["transaction_type", "type", "txn_type", "trans_type"],
    "amount": ["amount", "transaction_amount", "txn_amount"],
    "balance": ["balance", "balance_after_transaction", "closing_balance"],
    "description": ["description", "narration", "remarks", "memo"],
}


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def canonical_names(df: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Rename the first accepted spelling found, unless the canonical name is there."""
    found = set(df.columns)
    renames = {}
    for canonical, spellings in (aliases or COLUMN_ALIASES).items():
        known = [s for s in spellings if s in found]
        if known and canonical not in found:
            renames[known[0]] = canonical
    return df.withColumnsRenamed(renames)


def nan_to_null(df: DataFrame) -> DataFrame:
    floating = [f.name for f in df.schema if f.dataType.typeName() in ("float", "double")]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floating})
