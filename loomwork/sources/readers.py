"""Sources: text tables, settings, label sets, fetched records, tasks. Network interfaces are not part of this library; it reads what they stored."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators import relational as R

#: Keys with personal data, which are never stored.
PERSONAL = ("contact_email", "contact_name", "contact_phone_no", "contact_address", "contact_fax_no", "email", "phone")


def read_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A CSV file as strings; an absent file is an empty table, a missing column null. The schema is never inferred."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    try:
        raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    return raw.select(*[(F.col(f"`{c}`") if c in raw.columns else F.lit(None).cast("string")).alias(c) for c in columns])


def parse_setting(value: str) -> bool | int | float | str | tuple[str, ...]:
    """A setting as boolean, integer, number, list (by bars) or text."""
    v = value.strip()
    if v.lower() in ("true", "false"):
        return v.lower() == "true"
    for kind in (int, float):
        try:
            return kind(v)
        except ValueError:
            pass
    return tuple(x.strip() for x in v.split("|")) if "|" in v else v


class Panel:
    """Typed settings. `get` falls back to a default, `require` raises; `floor` is a label set's own floor or the default one."""

    def __init__(self, rows: Mapping[str, str]):
        self.values = {k: parse_setting(v) for k, v in rows.items()}

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Panel:
        return cls({r["setting"]: r["value"] for r in read_csv(spark, path, ["setting", "value"]).collect()})

    def get(self, key: str, default=None):
        return self.values.get(key, default)

    def require(self, key: str):
        if key not in self.values:
            raise KeyError(f"setting {key!r} is missing")
        return self.values[key]

    def floor(self, label_set: str) -> float:
        return float(self.get(f"floor.{label_set}", self.require("floor.default")))

    def sql(self, key: str) -> str:
        """The setting as an SQL literal."""
        v = self.require(key)
        if isinstance(v, tuple):
            return "array(" + ", ".join("'" + x.replace("'", "''") + "'" for x in v) + ")"
        return str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int | float) else "'" + v.replace("'", "''") + "'"

    def fill(self, template: str) -> str:
        """A template with {{panel:key}} replaced."""
        return re.sub(r"\{\{panel:([\w.]+)\}\}", lambda m: self.sql(m.group(1)), template)


def by_suffix(df: DataFrame) -> DataFrame:
    """A label table with its own id and name columns (those that end in _id and _name) as label_id and label_name."""
    own_id = next(c for c in df.columns if c.endswith("_id"))
    own_name = next((c for c in df.columns if c.endswith("_name")), own_id)
    return df.withColumns({"label_id": F.col(own_id), "label_name": F.col(own_name)})


def is_active(df: DataFrame) -> DataFrame:
    """Rows that are active; a table without the column is."""
    return df.where(F.lower("active") == "true") if "active" in df.columns else df


def load_set(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Every label of a set, active or not: label_id, label_name, definition (white space squeezed), is_active, family, label_set. A file without rows, or without an id, a name and a definition, is an error."""
    raw = spark.read.csv(f"{folder}/{name}.csv", header=True, multiLine=True, escape='"')
    own = {end: next((c for c in raw.columns if c.endswith(end)), None) for end in ("_id", "_name")}
    if None in own.values() or "definition" not in raw.columns or raw.isEmpty():
        raise ValueError(f"{name}: needs rows with an id, a name and a definition")
    text = lambda c: F.trim(F.regexp_replace(F.coalesce(F.col(f"`{c}`"), F.lit("")), r"(?U)\s+", " "))
    active = F.lower(F.trim("active")) == "true" if "active" in raw.columns else F.lit(True)
    family = text("family") if "family" in raw.columns else F.lit("")
    return raw.select(F.trim(own["_id"]).alias("label_id"), F.trim(own["_name"]).alias("label_name"), text("definition").alias("definition"), F.coalesce(active, F.lit(False)).alias("is_active"), family.alias("family"), F.lit(name).alias("label_set"))


def load_patterns(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The active word patterns of a set: label_id, pattern_id, pattern, case_sensitive. An absent file is an empty table; an unknown flag, or a pattern that does not compile, is an error."""
    raw = is_active(_optional(spark, f"{folder}/{name}_patterns.csv", ["label_id", "pattern_id", "pattern", "flags", "active"]))
    flag = F.upper(F.trim(F.coalesce(F.nullif("flags", F.lit("")), F.lit("IGNORECASE"))))
    out = raw.select(F.trim("label_id").alias("label_id"), F.trim("pattern_id").alias("pattern_id"), "pattern", flag.alias("flag"))
    for r in out.collect():  # a set's patterns: a few dozen
        if r["flag"] not in ("IGNORECASE", "CASE_SENSITIVE"):
            raise ValueError(f"{name}: pattern {r['pattern_id']} has the flag {r['flag']}")
        try:
            spark._jvm.java.util.regex.Pattern.compile(r["pattern"] or "")
        except Exception as e:
            raise ValueError(f"{name}: pattern {r['pattern_id']} does not compile") from e
    return out.select("label_id", "pattern_id", "pattern", (F.col("flag") == "CASE_SENSITIVE").alias("case_sensitive"))


def load_types(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The active types of a set: label_id, type_id, type_name, definition, merge_into, display_name; an absent file is an empty table."""
    raw = is_active(_optional(spark, f"{folder}/{name}_types.csv", ["label_id", "type_id", "type_name", "definition", "merge_into", "display_name", "active"]))
    text = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))
    return raw.select(*[text(F.col(c)).alias(c) for c in ("label_id", "type_id", "type_name", "definition", "merge_into", "display_name")])


def _optional(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A file that may be absent; rows of a table without `active` are active."""
    df = read_csv(spark, path, columns)
    return df.withColumn("active", F.coalesce("active", F.lit("true")))


def apply_views(spark: SparkSession, panel: Panel, files: Mapping[str, str]) -> list[str]:
    """Runs SQL files (name to text) in the order of their names, settings filled in, statement by statement; one that fails is fatal and named. Returns the names."""
    for name in sorted(files):
        for statement in re.split(r";\s*(?:\n|$)", re.sub(r"(?m)^\s*--.*$", "", panel.fill(files[name]))):
            if statement.strip():
                try:
                    spark.sql(statement)
                except Exception as e:
                    raise RuntimeError(f"{name}: {statement.strip()[:80]}") from e
    return sorted(files)


def type_resolution(types: DataFrame) -> DataFrame:
    """type_id, merged (what it is shown as) and its name."""
    t = types.select("type_id", F.coalesce(F.nullif("merge_into", F.lit("")), "type_id").alias("merged"))
    names = types.select(F.col("type_id").alias("merged"), F.coalesce(F.nullif("display_name", F.lit("")), "type_name").alias("type_name"))
    return t.join(names, "merged", "left")


def label_queries(labels: DataFrame, phrases: DataFrame) -> DataFrame:
    """query_id, label_id, query, sha: a definition query ('name: definition') for each label, and its active phrases, white space squeezed."""
    squeeze = lambda c: F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    own = labels.select(F.concat("label_id", F.lit(":definition")).alias("query_id"), "label_id", squeeze(F.concat_ws(": ", "label_name", "definition")).alias("query"))
    more = is_active(phrases).select(F.concat_ws(":", "label_id", "query_id").alias("query_id"), "label_id", squeeze(F.col("query")).alias("query"))
    return own.unionByName(more).withColumn("sha", F.sha2("query", 256))


def whole_files(spark: SparkSession, path: str, head: bytes = b"%PDF", tail: bytes = b"%%EOF") -> DataFrame:
    """path, length, whole of fetched files: those that begin and end as their kind does."""
    f = spark.read.format("binaryFile").load(path)
    begins = F.substring("content", 1, len(head)) == F.lit(bytearray(head))
    ends = F.instr(F.decode(F.substring("content", -1024, 1024), "ISO-8859-1"), tail.decode()) > 0
    return f.select("path", "length", (begins & ends).alias("whole"))


def plan_texts(spark: SparkSession, path: str) -> DataFrame:
    """plan_version (the file's name) and text of each text rendition."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1).alias("plan_version"), F.col("value").alias("text"))


def records(df: DataFrame) -> DataFrame:
    """Records without the columns that hold personal data."""
    return df.drop(*PERSONAL)


def notices(raw: DataFrame) -> DataFrame:
    """Fetched notices (JSON, strings) as the notices table: ISO dates, normalised references."""
    date = lambda c: F.to_date(F.nullif(S.iso_date(F.col(c)), F.lit("")))
    return records(raw).select(F.col("id").alias("notice_id"), "project_id", "notice_type", "notice_status", date("noticedate").alias("publication_date"), date("submission_deadline_date").alias("deadline_date"), F.col("bid_reference_no").alias("borrower_ref"), S.norm_ref(F.col("bid_reference_no")).alias("borrower_ref_norm"), F.col("bid_description").alias("description"))


def awards(raw: DataFrame) -> DataFrame:
    """Fetched awards with suppliers (array of name, country, amount) flattened: distinct names and countries by bars, the amounts' sum, null without any."""
    names = lambda f: F.array_join(F.array_distinct(F.filter(F.transform("suppliers", lambda s: s[f]), lambda x: x.isNotNull() & (x != ""))), "|")
    amounts = F.filter(F.transform("suppliers", lambda s: S.number(s["amount"])), lambda x: x.isNotNull())
    total = F.when(F.size(amounts) > 0, F.aggregate(amounts, F.lit(0.0), lambda a, x: a + x))
    return records(raw).withColumns({"supplier_name": names("name"), "supplier_country": names("country"), "supplier_amount": total}).drop("suppliers")


def merge_records(first: DataFrame, second: DataFrame, key: str, prefer_first: Sequence[str]) -> DataFrame:
    """Two interfaces' records as one: some fields from the first where it has them, the others from the second; record_source says which were there."""
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    fields = [c for c in dict.fromkeys([*first.columns, *second.columns]) if c != key]
    a = first.select(F.col(key), *[blank(c).alias(f"a_{c}") for c in first.columns if c != key], F.lit(True).alias("a_"))
    b = second.select(F.col(key), *[blank(c).alias(f"b_{c}") for c in second.columns if c != key], F.lit(True).alias("b_"))

    def pick(c: str):
        both = [F.col(f"{p}_{c}") for p, t in (("a", first), ("b", second)) if c in t.columns]
        return F.coalesce(*(both if c in prefer_first else both[::-1])).alias(c)

    source = F.when(F.col("a_") & F.col("b_"), "both").when(F.col("a_"), "first").otherwise("second")
    return a.join(b, key, "full").select(key, *[pick(c) for c in fields], source.alias("record_source"))


def candidates(records_: DataFrame, from_year: int, to_year: int) -> DataFrame:
    """Approved projects of the years, the first record of each id, by year and id."""
    r = records_.where(F.col("approval_date").isNotNull()).withColumn("approval_fiscal_year", S.fiscal_year(F.col("approval_date"))).where(F.col("approval_fiscal_year").between(from_year, to_year))
    return R.first_per_key(r, ["project_id"], [F.col("approval_date").asc(), F.col("project_name").asc_nulls_last()]).orderBy("approval_fiscal_year", "project_id")


def select_projects(cohort: DataFrame, project: str | None = None, country: str | None = None, region: str | None = None, fiscal_year: str | None = None, practice: str | None = None, cohort_set: str | None = None) -> DataFrame:
    """The cohort by its filters, all of which must hold: ids exact, a country any of a list by bars, region and practice a part of the text in any case, a year as 2024, FY24 or FY2024. A blank filter and an unknown id are errors."""
    out = cohort
    for name, value in (("project", project), ("country", country), ("region", region), ("fiscal_year", fiscal_year), ("practice", practice), ("cohort_set", cohort_set)):
        if value is not None and not value.strip():
            raise ValueError(f"the filter {name} is blank")
    if project:
        ids = [p.strip() for p in project.split("|")]
        known = {r[0] for r in cohort.where(F.col("project_id").isin(*ids)).select("project_id").collect()}
        if missing := [p for p in ids if p not in known]:
            raise ValueError(f"not in the cohort: {', '.join(missing)}")
        out = out.where(F.col("project_id").isin(*ids))
    if country:
        out = out.where(F.arrays_overlap(F.split("country_code", r"\|"), F.array(*[F.lit(c.strip().upper()) for c in country.split("|")])))
    for name, value in (("region", region), ("practice", practice)):
        if value:
            out = out.where(F.contains(F.lower(name), F.lit(value.lower())))
    if fiscal_year:
        m = re.fullmatch(r"(?:FY)?(\d{2}|\d{4})", fiscal_year.strip(), re.I)
        if not m:
            raise ValueError(f"not a fiscal year: {fiscal_year}")
        out = out.where(F.col("approval_fiscal_year") == int(m.group(1)) + (2000 if len(m.group(1)) == 2 else 0))
    return out.where(F.col("cohort_set") == cohort_set) if cohort_set else out


def read_tasks(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tasks, one JSON object a line; a repeated task_id is an error."""
    t = spark.read.json(path, schema=schema)
    if twice := t.groupBy("task_id").count().where("count > 1").select("task_id").limit(5).collect():
        raise ValueError(f"task ids that repeat: {[r[0] for r in twice]}")
    return t


def check_complete(df: DataFrame, expected: int) -> DataFrame:
    """`df`, if it has the rows its source promised."""
    n = df.count()
    if n != expected:
        raise ValueError(f"{n} rows of {expected}")
    return df


def check_keys(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """`df`, if each required column is there and not null throughout: a renamed key shows as an all-null column."""
    if absent := [c for c in required if c not in df.columns]:
        raise ValueError(f"columns missing: {absent}")
    n = df.agg(F.count("*").alias("__n"), *[F.count(c).alias(c) for c in required]).first()
    if n["__n"] and (empty := [c for c in required if not n[c]]):
        raise ValueError(f"columns without a value: {empty}")
    return df
