"""Page selectors and readers of page-keyed JSON, TSV and maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPAN = T.StructType([T.StructField("t", T.StringType()), T.StructField("c", T.StringType())])
BLOCK = T.StructType([T.StructField("type", T.StringType()), T.StructField("verse_num_am", T.StringType()), T.StructField("spans", T.ArrayType(SPAN))])
_FLAGGED = {"corrections": [("printed", T.StringType()), ("suggested", T.StringType()), ("reason", T.StringType()), ("applied", T.BooleanType()), ("dismissed", T.BooleanType())], "uncertain": [("text", T.StringType()), ("why", T.StringType())], "clipped": [("edge", T.StringType()), ("note", T.StringType())]}
#: A transcript; the three review arrays stay null where the file lacks them.
TRANSCRIPT = T.StructType(
    [T.StructField("page", T.IntegerType()), T.StructField("notes", T.StringType()), T.StructField("blocks", T.ArrayType(BLOCK))]
    + [T.StructField(k, T.ArrayType(T.StructType([T.StructField(n, x) for n, x in v]))) for k, v in _FLAGGED.items()]
    + [T.StructField("_source", T.StringType())]
)


def select_pages(spec: str, total: int, strict: bool = True, sample: tuple[int, ...] = ()) -> list[int]:
    """`all`, `n`, `a-b` and lists of them, sorted and without repeats.

    Strict refuses empty, reversed and outlying parts; otherwise empty parts are
    passed over, nothing is checked against the book, and `sample` names a list
    of pages.
    """
    if spec.strip() == "all":
        return list(range(1, total + 1))
    if not strict and spec.strip() == "sample":
        return list(sample)
    pages: set[int] = set()
    for part in spec.split(","):
        part = part.strip()
        if not part:
            if strict:
                raise ValueError(f"empty part in {spec!r}")
            continue
        low, dash, high = part.partition("-")
        try:
            first, last = int(low), int(high) if dash else int(low)
        except ValueError:
            raise ValueError(f"not a page: {part!r}") from None
        if strict and not 1 <= first <= last <= total:
            raise ValueError(f"{part!r} is not within 1-{total}")
        pages |= set(range(first, last + 1))
    return sorted(pages)


def selected(df: DataFrame, spec: str, total: int, strict: bool = True, sample: tuple[int, ...] = (), page: str = "page") -> DataFrame:
    """The rows of the asked pages. Pages come as ranges, so a filter on them stays short and reaches the scan."""
    asked, ranges = select_pages(spec, total, strict, sample), []
    for p in asked:
        if ranges and ranges[-1][1] == p - 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    hit = F.lit(False)
    for low, high in ranges:
        hit = hit | F.col(page).between(low, high)
    return df.where(hit)


def canonical_page(name: Column) -> Column:
    """The page of a canonical transcript file: page_, three digits or more, .json; null for sidecars and anything else."""
    return F.nullif(F.regexp_extract(name, r"^page_(\d{3,})\.json\z", 1), F.lit("")).cast("int")


def read_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical transcript files only: page_, three digits or more, .json; the raw text is kept for hashing."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    raw = spark.read.text(folder, wholetext=True).select(F.col("value").alias("raw_json"), canonical_page(name).alias("file_page"))
    raw = raw.where("file_page IS NOT NULL")
    return raw.select("file_page", "raw_json", F.from_json("raw_json", TRANSCRIPT).alias("x")).select("file_page", "x.*", "raw_json")


def page_map(df: DataFrame, column: str) -> DataFrame:
    """A map keyed by page strings to rows with an int key."""
    return df.select(F.explode(column).alias("_k", "value")).select(F.regexp_extract("_k", r"(\d+)$", 1).cast("int").alias("page"), "value")


def read_words_tsv(spark: SparkSession, path: str, least: float = 20.0) -> DataFrame:
    """Recognised words of a TSV: level 5, not blank, numeric confidence of at least `least`."""
    raw = spark.read.option("header", True).option("sep", "\t").option("quote", "").csv(path)
    return raw.where((F.col("level") == 5) & (F.trim("text") != "") & (F.expr("try_cast(conf as double)") >= least))


def flatten_response(responses: DataFrame, column: str = "pages") -> DataFrame:
    """Words of a page/block/paragraph/word/symbol tree: text, envelope, confidence, break after, parent block."""
    r = responses.select("page", F.posexplode(f"{column}.blocks").alias("p", "blocks")).select("page", F.posexplode("blocks").alias("block", "b"))
    r = r.select("page", "block", F.posexplode("b.paragraphs").alias("par", "g")).select("page", "block", "par", F.posexplode("g.words").alias("word", "w"))
    xs, ys = F.expr("transform(w.vertices, v -> coalesce(v.x, 0))"), F.expr("transform(w.vertices, v -> coalesce(v.y, 0))")
    text = F.expr("array_join(transform(w.symbols, s -> s.text), '')")
    last = F.try_element_at("w.symbols", F.lit(-1))["break"]
    out = r.select("page", "block", "par", "word", text.alias("text"), F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2"), F.col("w.confidence").alias("conf"), last.alias("break_after"))
    return out.where("text <> ''")
