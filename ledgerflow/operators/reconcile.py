"""Sources with a usable token, and mailbox folders against the folder table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.keys import digest_bucket
from ledgerflow.operators.joins import lookup_join

TOKEN_COLUMNS = [
    "oauth2_access_token",
    "oauth2_refresh_token",
    "oauth2_access_token_expires_at",
    "oauth2_refresh_token_expires_at",
]
NATURAL_KEY = ["source_id", "folder_name", "uid_validity"]
ID_BUCKETS = 4096


def token_state(now: Column) -> Column:
    """``valid`` while the access token's expiry lies ahead, else ``needs_refresh``.

    Expiry times carry no zone and mean UTC; ``now`` is given the same way.
    """
    return F.when(F.col("oauth2_access_token_expires_at") > now, F.lit("valid")).otherwise(
        F.lit("needs_refresh")
    )


def source_tokens(sources: DataFrame, refreshes: DataFrame, now: Column) -> DataFrame:
    """``(source_id, token_state, access_token)`` of every source.

    A valid token is used as it is, otherwise the refresh result counts; no token
    and an empty token both come out NULL.
    """
    renewed = refreshes.select("source_id", "new_token")
    token = F.when(F.col("token_state") == "valid", F.col("oauth2_access_token")).otherwise(
        F.col("new_token")
    )
    return (
        sources.select(F.col("id").alias("source_id"), *TOKEN_COLUMNS)
        .withColumn("token_state", token_state(now))
        .join(renewed, "source_id", "left")
        .select("source_id", "token_state", F.nullif(token, F.lit("")).alias("access_token"))
    )


def eligible_sources(sources: DataFrame, tokens: DataFrame) -> DataFrame:
    """Sources with a usable token; the token columns themselves are dropped."""
    usable = tokens.filter(F.col("access_token").isNotNull()).select(
        F.col("source_id").alias("id")
    )
    return sources.drop(*TOKEN_COLUMNS).join(usable, "id", "left_semi")


def listed_folders(listing: DataFrame) -> DataFrame:
    """The listing under the folder table's column names, each folder once."""
    return listing.select(
        "source_id", F.col("name").alias("folder_name"), "uid_validity"
    ).distinct()


def reconcile_existing(listing: DataFrame, folders: DataFrame) -> DataFrame:
    """Listed folders that are known, with their id.

    The table has no unique rule for the natural key; among equals the lowest id counts.
    """
    known = folders.groupBy(*NATURAL_KEY).agg(F.min("id").alias("id"))
    return listed_folders(listing).join(known, NATURAL_KEY)


def reconcile_missing(listing: DataFrame, folders: DataFrame) -> DataFrame:
    """Listed folders that are not known, a changed validity epoch among them.

    The row of the old epoch stays in the table but is no longer listed.
    """
    return listed_folders(listing).join(
        folders.select(*NATURAL_KEY), NATURAL_KEY, "left_anti"
    )


def assign_ids(rows: DataFrame, key: list[str], start: Column, name: str = "id") -> DataFrame:
    """Number rows past ``start`` without bringing them together in one task.

    Rows are spread over a fixed number of digest buckets, ranked within each, and
    rank and bucket interleave into one number: unique, the same on every run, and
    with gaps only where the buckets differ in size.  ``key`` must be unique.
    """
    text = F.concat_ws("/", *[F.col(c).cast("string") for c in key])
    order = Window.partitionBy("_bucket").orderBy(*key)
    return (
        rows.withColumn("_bucket", digest_bucket(text))
        .withColumn(
            name,
            start
            + (F.row_number().over(order) - 1).cast("bigint") * ID_BUCKETS
            + F.col("_bucket")
            + 1,
        )
        .drop("_bucket")
    )


def create_folders(missing: DataFrame, folders: DataFrame, now: Column) -> DataFrame:
    """New folder rows with ids past the table's highest and no marks yet."""
    highest = folders.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return assign_ids(missing.select(*NATURAL_KEY), NATURAL_KEY, highest).select(
        "id",
        *NATURAL_KEY,
        F.lit(None).cast("bigint").alias("high_water_mark"),
        F.lit(None).cast("bigint").alias("low_water_mark"),
        F.lit(None).cast("timestamp").alias("last_processed_at"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )


def all_folders(existing: DataFrame, created: DataFrame) -> DataFrame:
    """Ids a run goes through: the known folders and the new ones."""
    columns = ["id", *NATURAL_KEY]
    return existing.select(*columns).unionByName(created.select(*columns))


def folder_with_source(wanted: DataFrame, folders: DataFrame, sources: DataFrame) -> DataFrame:
    """Folder and source fields for ``(source_folder_id)`` rows, with an error where one is gone."""
    folder_fields = folders.select(F.col("id").alias("source_folder_id"), *NATURAL_KEY)
    source_fields = sources.select(
        F.col("id").alias("source_id"), "user_id", "email_address"
    ).withColumn("source_found", F.lit(True))
    located = wanted.select("source_folder_id").join(folder_fields, "source_folder_id", "left")
    joined = lookup_join(
        located, source_fields, ["source_id"], how="left"
    )
    error = F.when(
        F.col("folder_name").isNull(),
        F.concat(
            F.lit("Source folder "), F.col("source_folder_id").cast("string"), F.lit(" not found")
        ),
    ).when(
        F.col("source_found").isNull(),
        F.concat(F.lit("Source "), F.col("source_id").cast("string"), F.lit(" not found")),
    )
    return joined.select(
        "source_folder_id", *NATURAL_KEY, "user_id", "email_address", error.alias("error")
    )


def folder_token(folder_ids: DataFrame, folders: DataFrame, tokens: DataFrame) -> DataFrame:
    """``(source_folder_id, source_id, access_token)``; folders without a token are skipped."""
    owners = folders.select(F.col("id").alias("source_folder_id"), "source_id")
    usable = tokens.filter(F.col("access_token").isNotNull()).select("source_id", "access_token")
    owned = folder_ids.select("source_folder_id").join(owners, "source_folder_id")
    return lookup_join(owned, usable, ["source_id"]).select(
        "source_folder_id", "source_id", "access_token"
    )


def message_context(messages: DataFrame, folders: DataFrame, sources: DataFrame) -> DataFrame:
    """User, source and folder fields on every message of a known folder."""
    owners = sources.select(F.col("id").alias("source_id"), "user_id")
    folder_rows = folders.select(F.col("id").alias("source_folder_id"), *NATURAL_KEY)
    context = lookup_join(folder_rows, owners, ["source_id"])
    return lookup_join(messages, context, ["source_folder_id"])
