"""Delimited and JSON inputs, read in parallel without schema inference."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.functions.parsing import mcc_key
from cardwarden.schemas import CARD_COLUMNS, OPTIONAL_COLUMNS, USER_COLUMNS
from cardwarden.session import staging_root
from cardwarden.sources.records import SPLIT, land_pieces, whole_records
from cardwarden.sources.staging import stage
from cardwarden.sources.validate import require_columns

DELIMITERS = (",", ";", "\t", "|")
# JSON strings, and a member that comes after n opening braces of its piece.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_OPENED = rf"(?:{_STRING}\s*:\s*)?\{{\s*"
_MEMBERS = [rf"(?s)^\s*(?:{_OPENED}){{{n}}}({_STRING})\s*:\s*({_STRING})?" for n in range(3)]
# What stands before and at closing brackets: a piece holds several only where objects follow one another.
_CLOSED = rf'(?s)[^"}}\]]*+(?:{_STRING}[^"}}\]]*+)*+[}}\]]*+'


def choose_delimiter(lines: list[str]) -> str:
    """Candidate that splits every sampled line into the same, largest number of fields."""
    unquoted = [re.sub(r'"[^"]*"', "", line) for line in lines if line.strip()]
    if not unquoted:
        return ","
    best, best_rank = ",", (False, 0)
    for candidate in DELIMITERS:
        counts = [line.count(candidate) for line in unquoted]
        rank = (min(counts) == max(counts), counts[0])
        if counts[0] > 0 and rank > best_rank:
            best, best_rank = candidate, rank
    return best


def detect_delimiter(spark: SparkSession, path: str, sample_lines: int = 20) -> str:
    """Delimiter of a text file, from its first lines; comma when nothing fits."""
    head = spark.read.text(path).limit(sample_lines).collect()
    return choose_delimiter([row.value for row in head])


def _odd(value: Column) -> Column:
    """Whether the text has an odd number of quotes."""
    return F.length(F.regexp_replace(value, '[^"]', "")) % 2 == 1


def read_delimited(spark: SparkSession, path: str, delimiter: str | None = None, quoted_breaks: bool | None = None) -> DataFrame:
    """All columns as text, named by the header. Cells are typed later by ``try_`` casts, so a
    malformed one turns into null and never fails the scan.

    A quoted cell may hold line breaks (they are read as ``\\n``). Files in which every line has an even number
    of quotes go to Spark's reader; the others are put together from their lines, split by split.
    ``quoted_breaks`` says whether there are such files; where it is None, the lines are scanned once for that.
    """
    options = {
        "header": True,
        "sep": delimiter or detect_delimiter(spark, path),
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        # An unquoted empty cell is null, a quoted one is the empty string.
        "nullValue": "\u0000",
        "emptyValue": "",
    }
    # Only the header line is read here.
    names = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    reader = spark.read.schema(schema).options(**options, enforceSchema=False)
    if quoted_breaks is False:
        return reader.csv(path)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    odd = {r["file"]: r["odd"] for r in lines.groupBy("file").agg(F.max(_odd(F.col("value"))).alias("odd")).collect()}
    if not any(odd.values()):
        return reader.csv(path)
    mended = _broken_lines(spark, [f for f, any_odd in odd.items() if any_odd], names, options)
    calm = [f for f, any_odd in odd.items() if not any_odd]
    return reader.csv(calm).unionByName(mended) if calm else mended


def _broken_lines(spark: SparkSession, paths: list[str], names: list[str], options: dict) -> DataFrame:
    """Rows of files in which a quoted cell goes over several lines."""
    sep = f"[{options['sep']}]"
    pieces = land_pieces(spark, spark.read.text(paths).select("value"), f"lines-{uuid.uuid4().hex}")
    odd = _odd(F.col("value"))
    # Without doubled quotes and whole cells, a quote at the start of a cell opens one that the line does not close;
    # any other odd quote closes one, or is an ordinary character where none is open.
    single = F.replace("value", F.lit('""'), F.lit(""))
    opens = F.regexp_replace(single, f'(^|{sep})"[^"]*"(?={sep}|$)', "$1").rlike(f'(^|{sep})"')
    states = pieces.withColumns({"flips": (odd & opens).cast("int"), "closes": odd & ~opens})
    first = pieces.groupBy(F.col("file").alias("h_file")).agg(F.min_by("value", F.struct("block", "place")).alias("head"), F.min(F.struct("block", "place")).alias("h_place"))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    cells = F.from_csv("value", schema, {k: str(v) for k, v in options.items() if k != "header"})
    head = F.from_csv("head", schema, {k: str(v) for k, v in options.items() if k != "header"})
    # one row a file
    records = whole_records(states, "\n").join(F.broadcast(first), F.col("file") == F.col("h_file"))
    known = F.array(*[F.coalesce(head[f"c{i}"], F.lit("")) for i in range(len(names))]) == F.array(*[F.lit(n) for n in names])
    rows = records.where((F.struct("block", "place") != F.col("h_place")) & (F.trim("value") != ""))
    rows = rows.where(F.when(known, True).otherwise(F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean")))
    return rows.select(cells.alias("cells")).select(*[F.col(f"cells.c{i}").alias(n) for i, n in enumerate(names)])


def _with_optional(df: DataFrame, kind: str) -> DataFrame:
    missing = [c for c in OPTIONAL_COLUMNS[kind] if c not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])


def scan_transactions(spark: SparkSession, path: str, delimiter: str | None = None, quoted_breaks: bool | None = None) -> DataFrame:
    """Raw transactions, every column text, ``id`` renamed to ``transaction_id``."""
    raw = read_delimited(spark, path, delimiter, quoted_breaks)
    require_columns(raw, "transactions")
    return _with_optional(raw, "transactions").withColumnRenamed("id", "transaction_id")


def load_users(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    raw = read_delimited(spark, path, delimiter)
    require_columns(raw, "users")
    return user_columns(_with_optional(raw, "users"))


def load_cards(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    raw = read_delimited(spark, path, delimiter)
    require_columns(raw, "cards")
    return card_columns(_with_optional(raw, "cards"))


def user_columns(raw: DataFrame) -> DataFrame:
    """The known user columns that are present, typed; money stays text until cleaning."""
    types = {"current_age": "int", "credit_score": "int", "latitude": "double", "longitude": "double"}
    named = raw.withColumnRenamed("id", "user_id")
    return named.select(
        *[
            F.col(c).try_cast(types.get(c, "string")).alias(c)
            for c in USER_COLUMNS
            if c in named.columns
        ]
    )


def card_columns(raw: DataFrame) -> DataFrame:
    named = raw.withColumnRenamed("id", "card_id")
    return named.select(
        *[F.col(c).cast("string").alias(c) for c in CARD_COLUMNS if c in named.columns]
    )


def load_mcc(spark: SparkSession, path: str) -> DataFrame:
    """``{"5812": "..."}`` to rows. Category codes have four digits, so the object holds at most
    ten thousand entries and may be parsed as one value."""
    whole = spark.read.text(path, wholetext=True)
    pairs = whole.select(F.explode(F.from_json("value", "map<string,string>")))
    return pairs.select(
        mcc_key(F.col("key")).alias("mcc"), F.col("value").alias("mcc_description")
    )


def load_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label object, nested under ``target`` or flat, to (transaction_id, is_fraud) rows; only the answer "Yes" is a fraud.

    Where a file has a ``target``, nothing outside it counts. The object may hold billions of members, so it is
    never parsed as one value: the text is cut at commas, in parallel, and landed once; pieces that a comma inside
    quotes tore apart are put together again. How many braces are open before a piece, and under which key, is
    carried from split to split like the quotes: only pieces with brackets change it, and a split without any is
    read without a window. As in any JSON object, a repeated id keeps its last answer; the repeats are merged
    before the shuffle.
    """
    name = uuid.uuid4().hex
    pieces = land_pieces(spark, spark.read.option("lineSep", ",").text(path).select("value"), f"labels-{name}")
    torn = _odd(F.regexp_replace("value", r"(?s)\\.", ""))
    if pieces.where(torn).isEmpty():
        records = pieces
    else:
        records = whole_records(pieces.withColumns({"flips": torn.cast("int"), "closes": F.lit(False)}), ",")
        records = stage(records, f"{staging_root(spark)}/pieces/mended-{name}")
    closed = F.when(F.col("value").rlike(r"[}\]]"), F.regexp_extract_all("value", F.lit(f"({_CLOSED})"), 1)).otherwise(F.array("value"))
    parts = records.select(*SPLIT, "place", F.posexplode(closed).alias("nth", "value")).where("value != ''")
    bare = F.when(F.col("value").rlike(r"[{}\[\]]"), F.regexp_replace("value", _STRING, "")).otherwise("")
    opened, shut = F.length(F.regexp_replace(bare, r"[^{\[]", "")), F.length(F.regexp_replace(bare, r"[^}\]]", ""))
    return _members(parts.withColumns({"depth_change": opened - shut, "brackets": opened + shut > 0}))


def _members(parts: DataFrame) -> DataFrame:
    in_split, in_file = Window.partitionBy(*SPLIT).orderBy("place", "nth"), Window.partitionBy("file").orderBy("block")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c, w: F.coalesce(F.sum(c).over(before(w)), F.lit(0))

    def member(depth: Column, group: int) -> Column:
        """Key (1) or text value (2) of the member at that depth of the object; empty where there is none."""
        found = F.lit("")
        for n, pattern in enumerate(_MEMBERS):
            found = F.when(depth - F.col("depth") == n, F.regexp_extract("value", pattern, group)).otherwise(found)
        return found

    def outer_key() -> Column:
        return F.when(F.col("brackets") & (F.col("depth") <= 1), F.nullif(member(F.lit(1), 1), F.lit("")))

    # One row a split in all of these.
    changes = parts.groupBy(*SPLIT).agg(F.sum("depth_change").alias("change"), F.max("brackets").alias("uneven"))
    depths = changes.select(*SPLIT, "uneven", earlier("change", in_file).alias("from_depth"))
    events = parts.where("brackets").join(F.broadcast(depths), SPLIT)
    events = events.withColumn("depth", F.col("from_depth") + earlier("depth_change", in_split)).withColumn("outer", outer_key())
    last = events.groupBy(*SPLIT).agg(
        F.max_by("outer", F.when(F.col("outer").isNotNull(), F.struct("place", "nth"))).alias("last_outer"),
        F.max(F.col("outer") == '"target"').alias("target"),
    )
    splits = depths.join(last, SPLIT, "left").select(
        *SPLIT, "uneven", "from_depth", F.last("last_outer", ignorenulls=True).over(before(in_file)).alias("from_outer"),
        F.when(F.max("target").over(Window.partitionBy("file")), 2).otherwise(1).alias("wanted"),
    )
    tagged = parts.join(F.broadcast(splits), SPLIT)
    even = tagged.where("not uneven").withColumns({"depth": F.col("from_depth"), "outer": F.col("from_outer")})
    uneven = tagged.where("uneven").withColumn("depth", F.col("from_depth") + earlier("depth_change", in_split))
    upto = in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    uneven = uneven.withColumn("outer", F.coalesce(F.last(outer_key(), ignorenulls=True).over(upto), F.col("from_outer")))
    placed = even.unionByName(uneven)
    counts = (F.col("wanted") == 1) | (F.col("outer") == '"target"')
    found = placed.select(
        member(F.col("wanted"), 1).alias("key"), (member(F.col("wanted"), 2) == '"Yes"').alias("is_fraud"),
        F.struct("file", "block", "place", "nth").alias("at"), counts.alias("counts"),
    ).where("counts and key != ''")
    key = F.when(F.col("key").contains("\\"), F.from_json(F.concat(F.lit("["), "key", F.lit("]")), "array<string>")[0])
    found = found.withColumn("transaction_id", key.otherwise(F.expr("substring(key, 2, length(key) - 2)")))
    return found.groupBy("transaction_id").agg(F.max_by("is_fraud", "at").alias("is_fraud"))
