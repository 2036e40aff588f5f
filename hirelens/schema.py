"""The posting relation: 14 string columns in a fixed order, and the technical order column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Column names of the data contract, in order.
COMPANY, TITLE, DEADLINE, REQ, PREF, CAREER, URL = "기업명", "공고명", "마감일", "지원자격", "우대사항", "경력", "URL"
SALARY, TECH, PLACE, SITE, RATING, FIRST, LAST = "연봉", "기술스택", "근무지", "사이트명", "평점", "최초수집일", "최종확인일"
COLUMNS = [COMPANY, TITLE, DEADLINE, REQ, PREF, CAREER, URL, SALARY, TECH, PLACE, SITE, RATING, FIRST, LAST]
SITES = ["wanted", "saramin", "jobkorea", "jobplanet", "jumpit"]
ORD = "_ord"

POSTING_SCHEMA = StructType([StructField(c, StringType(), False) for c in COLUMNS] + [StructField(ORD, LongType(), False)])


def as_postings(df: DataFrame) -> DataFrame:
    """The 14 columns of df, absent ones and nulls as empty strings, and its order column."""
    own = [(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(c) for c in COLUMNS]
    order = F.col(ORD).cast("long") if ORD in df.columns else F.monotonically_increasing_id()
    return df.select(*own, order.alias(ORD))
