"""Directory users, accounts, and reconciliation of access lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemsync.operators.joins import skew_join
from itemsync.schemas import DEFAULT_TIME_ZONE, PLATFORM_CLOUD, PLATFORM_ON_PREM


def accounts_on(accounts: DataFrame, platform: str) -> DataFrame:
    """The accounts that a run of one platform may touch; a table without platforms is of that one."""
    return accounts.filter(on_platform(F.col("platform"), platform)) if "platform" in accounts.columns else accounts


def on_platform(column: Column, platform: str) -> Column:
    """The configured platform name must occur in the column."""
    return column.contains(platform)


def directory_users(directory: DataFrame) -> DataFrame:
    """Persons that are users and carry a given name."""
    wanted = (F.col("category") == "person") & (F.col("class") == "user") & F.col("given_name").isNotNull()
    return directory.filter(wanted).select("entry_type", "mail", *_zone(directory))


def directory_accounts(users: DataFrame) -> DataFrame:
    """Accounts of a directory, without entries that only refer elsewhere."""
    return _accounts(users.filter(~F.col("entry_type").contains("searchResRef")), PLATFORM_ON_PREM)


def cloud_users(directory: DataFrame) -> DataFrame:
    """All users of the cloud directory, however many pages it has."""
    return directory.select("mail", *_zone(directory))


def cloud_accounts(users: DataFrame) -> DataFrame:
    return _accounts(users, PLATFORM_CLOUD)


def accounts_of(directory: DataFrame, platform: str) -> DataFrame:
    """Accounts of the configured platform."""
    if PLATFORM_ON_PREM in platform:
        return directory_accounts(directory_users(directory))
    return cloud_accounts(cloud_users(directory))


def _zone(directory: DataFrame) -> list[str]:
    return ["timezone"] if "timezone" in directory.columns else []


def _accounts(users: DataFrame, platform: str) -> DataFrame:
    zone = F.col("timezone") if "timezone" in users.columns else F.lit(DEFAULT_TIME_ZONE)
    return users.select(F.col("mail").alias("account"), zone.alias("timezone"), F.lit(platform).alias("platform"))


def revoked_identities(identities: DataFrame, accounts: DataFrame) -> DataFrame:
    """Identities none of whose permissions is a live address; an empty list has none.

    Permissions are exploded and matched by equality. An address that occurs in
    very many lists is spread over tasks.
    """
    listed = identities.withColumn("permissions", F.coalesce("permissions", F.array().cast("array<string>")))
    # an identity may occur with several lists, which their hash tells apart
    marked = listed.withColumn("_list", F.xxhash64("permissions"))
    live = accounts.select(F.col("account").alias("address")).distinct()
    pairs = marked.select("identity", "_list", F.explode("permissions").alias("address"))
    overlapping = skew_join(pairs, live, "address", "left_semi", spread=F.col("identity"))
    kept = overlapping.select("identity", "_list").distinct()
    return marked.join(kept, ["identity", "_list"], "left_anti").drop("_list")


def granted_permissions(accounts: DataFrame, mapping: DataFrame) -> DataFrame:
    """The target user of every account, who may read the source address."""
    targets = mapping.select(F.col("source").alias("account"), "target")
    return accounts.join(targets, "account", "left").select(
        F.coalesce("target", "account").alias("identity"), F.array("account").alias("permissions")
    )
