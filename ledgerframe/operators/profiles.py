"""Chain profiles: a small dimension joined by normalised name and network."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Chain name, network, uid, type, seconds between blocks.
PROFILES = (
    ("ethereum", "mainnet", "evm:1", "evm", 12.0),
    ("bsc", "mainnet", "evm:56", "evm", 0.45),
    ("polygon", "mainnet", "evm:137", "evm", 2.0),
    ("arbitrum", "mainnet", "evm:42161", "evm", 0.25),
    ("optimism", "mainnet", "evm:10", "evm", 2.0),
    ("solana", "mainnet", "sol:mainnet", "solana", 0.45),
    ("sui", "mainnet", "sui:mainnet", "sui", 1.0),
    ("aptos", "mainnet", "aptos:mainnet", "aptos", 0.2),
    ("bitcoin", "mainnet", "btc:mainnet", "utxo", 600.0),
    ("cosmoshub", "mainnet", "cosmos:cosmoshub-4", "cosmos", 6.0),
    ("near", "mainnet", "near:mainnet", "near", 1.2),
    ("avalanche", "mainnet", "avax:cchain", "evm", 2.0),
)


def profiles(spark: SparkSession, rows=PROFILES) -> DataFrame:
    """The profile table; a name and network that come twice are an error."""
    keys = [(a.strip().lower(), b.strip().lower()) for a, b, *_ in rows]
    if len(set(keys)) < len(keys):
        raise ValueError("duplicate chain profile")
    return spark.createDataFrame([(*k, *r[2:]) for k, r in zip(keys, rows, strict=True)], "chain string, network string, chain_uid string, chain_type string, interval_seconds double")


def chain_profile(df: DataFrame, check: bool = True) -> DataFrame:
    """df(chain, network) with the profile's fields. With check, an unknown chain is an error; else its fields are NULL."""
    own = profiles(df.sparkSession).withColumnsRenamed({"chain": "__c", "network": "__n"})
    joined = df.join(F.broadcast(own), (F.lower(F.trim("chain")) == F.col("__c")) & (F.lower(F.trim("network")) == F.col("__n")), "left").drop("__c", "__n")
    if not check:
        return joined
    known = F.when(F.col("chain_uid").isNull(), F.raise_error(F.concat_ws("/", F.lit("unknown chain profile"), "chain", "network"))).otherwise(F.col("chain_uid"))
    return joined.withColumn("chain_uid", known)
