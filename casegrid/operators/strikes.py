"""Values that are struck out on paper: which candidates fall, which aliases fall with them, which fields are blocked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text as X


def struck_sets(struck: DataFrame) -> DataFrame:
    """case_id, everywhere, aliases: what is struck in a case wherever it stands, and all that is struck in it without
    white space and stops. A case's marks are few."""
    token = F.lower("token")
    return struck.groupBy("case_id").agg(F.array_sort(F.collect_set(F.when(F.col("scope") == "global", token))).alias("everywhere"), F.array_sort(F.collect_set(X.compact(F.col("token")))).alias("aliases"))


def with_strikes(candidates: DataFrame, struck: DataFrame) -> DataFrame:
    """Candidates with ``struck`` (their value, or one of its tokens, is struck everywhere in the case) and ``tainted``
    (their value is an alias of a struck one: equal but for white space and stops)."""
    words = F.array_append(X.tokens(F.col("value")), F.lower("value"))
    joined = candidates.join(struck_sets(struck), "case_id", "left")
    # most cases have no marks; their values aren't cut into tokens
    hit = F.when(F.size("everywhere") > 0, F.coalesce(F.arrays_overlap(words, "everywhere"), F.lit(False))).otherwise(False)
    alias = F.when(F.size("aliases") > 0, (F.col("value") != "") & F.array_contains("aliases", X.compact(F.col("value")))).otherwise(False)
    return joined.withColumn("struck", hit).withColumn("tainted", alias).drop("everywhere", "aliases")


def taints(candidates: DataFrame, struck: DataFrame) -> DataFrame:
    """case_id, field, value (lower case): the values that fall with a struck one."""
    return with_strikes(candidates, struck).where("tainted").select("case_id", "field", F.lower("value").alias("value")).distinct()


def surviving(candidates: DataFrame, struck: DataFrame) -> DataFrame:
    """Candidates that are neither struck nor tainted; a pool that loses all of its candidates is unread."""
    return with_strikes(candidates, struck).where("not struck and not tainted").drop("struck", "tainted")


def approval_blocking(field: str, value: str):
    """Whether a value, if it held, would stand against an approval."""
    f, v = F.col(field), F.col(value)
    flags = X.flag_set(v)
    return (
        ((f == "risk_flags") & F.arrays_overlap(flags, F.array(*map(F.lit, vocab.FLAGS))))
        | ((f == "fee_status") & v.isin("unpaid", "unknown", "waived"))
        | ((f == "home_world") & v.isin(vocab.HARD_EMBARGO_WORLDS + vocab.SOFT_EMBARGO_WORLDS))
        | ((f == "visa_class") & (v == "TRANSIT-7"))
        | ((f == "sponsor_id") & v.isin(vocab.REVOKED_SPONSORS))
        | ((f == "arrival_date") & X.real_date(v).isNotNull())
    )


def blocked_fields(marked: DataFrame) -> DataFrame:
    """case_id, fields: fields of which a struck candidate would stand against an approval, sorted; from candidates with
    strikes."""
    down = marked.where("struck").where(approval_blocking("field", "value"))
    return down.groupBy("case_id").agg(F.array_sort(F.collect_set("field")).alias("fields"))
