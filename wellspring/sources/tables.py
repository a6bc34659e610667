"""Sources and sinks: manifests, delimited tables, partition keys in file names, samples, reference tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Partition keys and their letters in file names, as P-1_W-A1_T-5__reads.tsv.
KEYS = {"plate": "P", "well": "W", "tile": "T", "cycle": "C", "round": "R", "channel": "CH", "gene": "G", "sgrna": "SG", "cell_class": "CeCl", "channel_combo": "ChCo", "leiden_resolution": "LR"}


def manifest(spark: SparkSession, path: str, pattern: str, keys: list[str], integers: tuple[str, ...] = ("plate", "tile", "cycle"), recursive: bool = True, glob: str | None = None) -> DataFrame:
    """sample_fp and a typed column for each group of the pattern; raises where no file matches.

    Only names are read: the content column is never asked for.
    """
    df = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        df = df.option("pathGlobFilter", glob)
    files = df.load(path).select(F.col("path").alias("sample_fp")).where(F.col("sample_fp").rlike(pattern))
    out = files.select("sample_fp", *[F.regexp_extract("sample_fp", pattern, k + 1).cast("int" if c in integers else "string").alias(c) for k, c in enumerate(keys)])
    if out.isEmpty():
        raise ValueError(f"no file under {path} matches {pattern}")
    return out.orderBy(*keys)


def select_samples(samples: DataFrame, order: dict[str, list] | None = None, **where) -> DataFrame:
    """Rows whose keys, compared as text, equal the given ones; sorted by the position of keys in given lists."""
    for c, v in where.items():
        if v is not None:
            samples = samples.where(F.col(c).cast("string") == str(v))
    by = [F.array_position(F.array(*[F.lit(str(x)) for x in xs]), F.col(c).cast("string")) for c, xs in (order or {}).items()]
    return samples.orderBy(*by, "sample_fp")


def partition_combos(samples: DataFrame, path_col: str = "sample_fp") -> DataFrame:
    """The different keys, as text."""
    keys = [c for c in samples.columns if c != path_col]
    return samples.select(*[F.col(c).cast("string").alias(c) for c in keys]).distinct()


def file_name(keys: dict[str, object], info: str, extension: str) -> str:
    parts = [f"{letter}-{keys[k]}" for k, letter in KEYS.items() if keys.get(k) is not None]
    return f"{'_'.join(parts)}__{info}.{extension}" if parts else f"{info}.{extension}"


def parse_names(path: Column) -> dict[str, Column]:
    """Columns of the keys, info and extension in a file name. Values may hold underscores: the next key ends them."""
    name = F.element_at(F.split(path, "/"), -1)
    any_key = "|".join(KEYS.values())
    head = F.substring_index(name, "__", 1)
    out = {k: F.nullif(F.regexp_extract(head, rf"(?:^|_){letter}-(.*?)(?=_(?:{any_key})-|$)", 1), F.lit("")) for k, letter in KEYS.items()}
    tail = F.element_at(F.split(name, "__"), -1)
    return out | {"info": F.regexp_extract(tail, r"^(.*?)(?:\.[^.]*)?$", 1), "extension": F.regexp_extract(tail, r"\.([^.]*)$", 1)}


def tile_files(files: DataFrame) -> DataFrame:
    """One map from tile to path."""
    tile = parse_names(F.col("path"))["tile"].cast("int")
    return files.agg(F.map_from_entries(F.sort_array(F.collect_set(F.struct(tile.alias("k"), F.col("path").alias("v"))))).alias("files"))


def read_tables(spark: SparkSession, paths: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """Parquet, TSV or CSV by extension, many at once; NaN becomes null. Give a schema for text: inferring reads twice."""
    from wellspring.functions.stats import nan_to_null

    paths = [paths] if isinstance(paths, str) else paths
    kind = paths[0].rsplit(".", 1)[-1].lower()
    if kind in ("tsv", "csv", "txt"):
        r = spark.read.option("header", True).option("sep", "," if kind == "csv" else "\t").option("nanValue", "nan")
        return nan_to_null((r.schema(schema) if schema else r.option("inferSchema", True)).csv(paths))
    return nan_to_null((spark.read.schema(schema) if schema else spark.read).parquet(*paths))


def combine(frames: list[DataFrame]) -> DataFrame:
    """Union of tables that may lack each other's columns."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def infer_dtypes(df: DataFrame) -> DataFrame:
    """Text columns as boolean, whole or real numbers where every value is one; whole-valued reals as integers.

    One aggregate decides for all columns.
    """
    tests = {}
    for c, t in df.dtypes:
        v = F.col(f"`{c}`")
        if t == "string":
            tests[f"{c}|bool"] = F.bool_and(F.lower(v).isin("true", "false"))
            tests[f"{c}|number"] = F.bool_and(F.expr(f"try_cast(`{c}` AS double)").isNotNull() | v.isNull())
            tests[f"{c}|whole"] = F.bool_and(F.expr(f"try_cast(`{c}` AS double) % 1 = 0"))
        elif t in ("double", "float"):
            tests[f"{c}|whole"] = F.bool_and(F.isnan(v) | (v % 1 == 0))
    if not tests:
        return df
    row = df.agg(*[F.coalesce(t, F.lit(False)).alias(n) for n, t in tests.items()]).first()
    out = {}
    for c, t in df.dtypes:
        v = F.col(f"`{c}`")
        if t == "string" and row[f"{c}|bool"]:
            out[c] = F.lower(v) == "true"
        elif t == "string" and row[f"{c}|number"]:
            n = F.expr(f"try_cast(`{c}` AS double)")
            out[c] = n.cast("bigint") if row[f"{c}|whole"] else n
        elif t in ("double", "float") and row[f"{c}|whole"]:
            out[c] = F.when(~F.isnan(v), v).cast("bigint")
    return df.withColumns(out)


def sample_rows(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """n rows, the same ones whatever the partitions: the first by a hash of their keys (a top-n, no full sort)."""
    return df.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys).limit(n)


def sample_each(df: DataFrame, fraction: float, keys: list[str], seed: int = 42) -> DataFrame:
    """About this share of every part of the table, by a hash of the keys: no shuffle."""
    return df.where(F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1_000_000)) < int(fraction * 1_000_000))


def stage_metadata(table: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """x_pos, y_pos, z_pos in micrometres from columns of many names; those with mm in the name are multiplied by 1000."""
    aliases = aliases or {"x_pos": ["x_pos", "x_pos_mm", "x", "x_mm", "pos_x", "stage_x"], "y_pos": ["y_pos", "y_pos_mm", "y", "y_mm", "pos_y", "stage_y"], "z_pos": ["z_pos", "z_pos_mm", "z", "z_mm", "z_um", "stage_z"]}
    have = {c.lower().strip(): c for c in table.columns}
    out = {}
    for target, names in aliases.items():
        found = [(F.col(f"`{have[n]}`").cast("double") * (1000 if "mm" in n else 1)) for n in names if n in have]
        out[target] = F.coalesce(*found) if found else F.lit(None).cast("double")
    return table.withColumns(out)


def write_partitioned(df: DataFrame, path: str, keys: list[str], kind: str = "parquet", mode: str = "overwrite") -> None:
    """A folder for each key: what file names carried. Rows of a key are brought together first, so there are few files."""
    w = df.repartition(*[F.col(k) for k in keys]).write.mode(mode).partitionBy(*keys)
    w.option("header", True).option("sep", "\t").csv(path) if kind == "tsv" else w.parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def string_pairs(links: DataFrame, uniprot: DataFrame, least: int = 950) -> DataFrame:
    """pair, gene_name: two rows for each protein pair of high score, named by the entry whose first cross-reference it is."""
    ids = uniprot.select(F.split_part("string", F.lit(";"), F.lit(1)).alias("p"), F.get(F.split("gene_names", r"\s+"), F.lit(0)).alias("g")).where("p <> ''")
    ids = ids.groupBy("p").agg(F.min("g").alias("g"))
    strong = links.where(F.col("combined_score") >= least).select(F.col("protein1").alias("p1"), F.col("protein2").alias("p2"))
    named = strong.join(ids.select(F.col("p").alias("p1"), F.col("g").alias("a")), "p1").join(ids.select(F.col("p").alias("p2"), F.col("g").alias("b")), "p2")
    pairs = named.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    return pairs.select(F.xxhash64("a", "b").alias("pair"), F.explode(F.array("a", "b")).alias("gene_name"))


def complex_groups(table: DataFrame, group: str, genes: str, separator: str = ";") -> DataFrame:
    """gene_name, group from lists in one column."""
    return table.select(F.explode(F.split(genes, separator)).alias("gene_name"), F.col(group).alias("group")).select(F.trim("gene_name").alias("gene_name"), "group").where("gene_name <> ''").distinct()


def json_gene_sets(spark: SparkSession, path: str) -> DataFrame:
    """gene_name, group from {"group": {"geneSymbols": [...]}}."""
    raw = spark.read.option("wholetext", True).text(path)
    sets = raw.select(F.explode(F.from_json("value", "map<string, struct<geneSymbols: array<string>>>")).alias("group", "v"))
    return sets.select(F.explode("v.geneSymbols").alias("gene_name"), "group")


def uniprot_table(spark: SparkSession, path: str) -> DataFrame:
    """A downloaded table, column names in lower snake case."""
    df = spark.read.option("header", True).option("sep", "\t").csv(path)
    return df.toDF(*[c.strip().lower().replace(" ", "_").replace("(", "").replace(")", "") for c in df.columns])


def feature_columns(columns: list[str], metadata: list[str]) -> list[str]:
    return [c for c in columns if c not in set(metadata)]


def split_columns(df: DataFrame, metadata: list[str]) -> tuple[list[str], list[str]]:
    """(metadata, features); raises where a feature isn't numeric."""
    kinds = dict(df.dtypes)
    features = feature_columns(df.columns, metadata)
    bad = [c for c in features if kinds[c] not in ("tinyint", "smallint", "int", "bigint", "float", "double") and not kinds[c].startswith("decimal")]
    if bad:
        raise ValueError(f"not numeric: {bad}")
    return [c for c in df.columns if c in set(metadata)], features


def channel_subset(features: list[str], keep: list[str], channels: list[str], tokens: bool = False) -> list[str]:
    """Features without the other channels' names in them; tokens compares whole parts between underscores."""
    gone = [c for c in channels if c not in keep]
    has = (lambda f, c: f"_{c}_" in f"_{f}_") if tokens else (lambda f, c: c in f)
    return [f for f in features if not any(has(f, c) for c in gone)]


def table_features(features: list[str], extra: list[str] | None = None) -> list[str]:
    """Nucleus and cell features of the gene table, in the order intensity, shape, overlap, extra."""
    mine = [f for f in features if f.startswith(("nucleus_", "cell_"))]
    groups = [lambda f: f.endswith(("_mean", "_integrated", "_std", "_median")), lambda f: f.endswith(("_area", "_eccentricity", "_solidity", "_form_factor", "_perimeter")), lambda f: "correlation" in f or "overlap" in f or "manders" in f, lambda f: any(t in f for t in extra or [])]
    return list(dict.fromkeys(f for g in groups for f in mine if g(f)))


def ordered_columns(columns: list[str], metadata: list[str], label: str = "label") -> list[str]:
    """Label, metadata, others, then nucleus, cell and cytoplasm features."""
    rank = lambda c: 0 if c == label else 1 if c in metadata else next((k for k, p in ((3, "nucleus_"), (4, "cell_"), (5, "cytoplasm_")) if c.startswith(p)), 2)
    return sorted(columns, key=lambda c: (rank(c), metadata.index(c) if c in metadata else 0))
