"""Author names to staff accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressmark import constants as K, schemas

GENERIC = K.GENERIC_ACCOUNT


def default_accounts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(K.AUTHOR_ACCOUNTS.items()), schemas.ACCOUNTS)


def with_account(
    rows: DataFrame, name: str, accounts: DataFrame | None = None, generic: str = GENERIC
) -> DataFrame:
    """Replace ``name`` by ``author``, the account, and ``article_author``, the name to show.

    Authors with an account show no name; all others go under the generic account. With the
    fixed table the look-up is a map in the expression; a table of one's own is joined, and
    Spark broadcasts it when its known size allows.
    """
    key = F.lower(F.col(name))
    if accounts is None:
        known = F.create_map(*[F.lit(x) for pair in K.AUTHOR_ACCOUNTS.items() for x in pair])
        matched = rows.withColumn("_account", F.element_at(known, key))
    else:
        aliases = accounts.select(F.col("alias").alias("_alias"), F.col("account").alias("_account"))
        matched = rows.join(aliases, key == F.col("_alias"), "left").drop("_alias")
    shown = F.when(F.col("_account").isNull(), F.col(name))
    return matched.withColumns(
        {"author": F.coalesce("_account", F.lit(generic)), "article_author": shown}
    ).drop("_account", name)
