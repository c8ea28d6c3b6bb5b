"""Text sources as DataFrames: variants, intervals, gene models, genetic maps, matrices, fragments, sheets.

All are declared plans over Spark's csv and text readers with explicit schemas; gzip is read as it is. A file's
row order, where it matters, is kept in `row_id`. Matrices are long tables: dense or sparse numpy archives, MatrixMarket folders and
annotated matrices kept as Parquet; HDF5 files need a library that is not at hand and are converted to one of these before.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from locuslake import schema as S
from locuslake.functions.columns import format_map, info_map, phase_of, simplify_label


def _tsv(spark: SparkSession, path, schema, comment: str | None = "#", sep: str = "\t", header: bool = False) -> DataFrame:
    reader = spark.read.option("sep", sep).option("header", header).option("quote", "").schema(schema)
    if comment:
        reader = reader.option("comment", comment)
    return reader.csv(path)


def lines(spark: SparkSession, path) -> DataFrame:
    """(row_id, value): the lines of a text numbered from 0, without a task that sees them all."""
    d = spark.read.text(path).withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33))
    sizes = d.groupBy("_part").agg(F.count("*").alias("_n"))
    ahead = sizes.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
    return d.join(F.broadcast(ahead), "_part").select((F.col("_ahead") + F.col("_id").bitwiseAND((1 << 33) - 1)).alias("row_id"), "value")  # a row for each split


def vcf(spark: SparkSession, path, add_chr: bool = True, presorted: bool = True) -> DataFrame:
    """Variants with info and first-sample format fields as maps, pos0, key, gt and phase; 8 columns or 10 and more.

    Where the first row has no chr prefix, all rows get one. Rows are put in the order of chromosome, position and file
    unless `presorted`; a file without rows gives an empty table.
    """
    d = _tsv(spark, path, S.VCF)
    first = d.select("chrom").head(1)
    chrom = S.with_chr(F.col("chrom")) if add_chr and first and not str(first[0][0]).startswith("chr") else F.col("chrom")
    d = d.withColumn("chrom", chrom).withColumn("chrom_ord", S.chrom_ord(F.col("chrom"))).withColumn("row_id", F.monotonically_increasing_id())
    d = d.withColumn("pos0", F.col("pos") - 1).withColumn("key", F.concat_ws("_", "chrom", F.col("pos").cast("string")))
    d = d.withColumn("info", info_map(F.col("info"))).withColumn("fields", F.when(F.col("format").isNotNull(), format_map(F.col("format"), F.col("sample"))))
    d = d.withColumn("gt", F.try_element_at("fields", F.lit("GT")))
    d = d.withColumn("phase", F.when(F.col("gt").contains("|"), phase_of(F.col("gt"))))
    return d if presorted else d.orderBy("chrom_ord", "pos", "row_id")


def vcfs(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """Several variant files under one another; row_id counts within a file."""
    return reduce(DataFrame.unionByName, [vcf(spark, p, **options) for p in paths])


def panel_sites(variants: DataFrame) -> DataFrame:
    """(chrom, pos) of the single-base variants of a reference panel."""
    return variants.where((F.length("ref") == 1) & (F.length("alt") == 1)).select("chrom", "pos")


def chrom_sizes(spark: SparkSession, path) -> DataFrame:
    """(chrom, size); a line without exactly two fields raises when it is read."""
    parts = F.split(F.trim("value"), r"\s+")
    d = spark.read.text(path).where(F.trim("value") != "").withColumn("p", parts)
    bad = F.when(F.size("p") != 2, F.raise_error(F.concat(F.lit("not two fields: "), F.col("value"))))
    return d.select(F.coalesce(bad.cast("string"), F.col("p")[0]).alias("chrom"), F.col("p")[1].cast("long").alias("size"))


def bed(spark: SparkSession, path, add_chr: bool = True, names: bool = False) -> DataFrame:
    """(chrom, start, stop[, name]); further columns are left unread."""
    d = _tsv(spark, path, "chrom string, start long, stop long, name string" if names else S.BED3)
    return d.withColumn("chrom", S.with_chr(F.col("chrom"))) if add_chr else d


def bedgraph(spark: SparkSession, path) -> DataFrame:
    return _tsv(spark, path, S.BED4)


def depth(spark: SparkSession, path, sample_id: str, chroms: list[str] | None = None) -> DataFrame:
    d = _tsv(spark, path, S.BED4).withColumnRenamed("value", "depth").withColumn("sample_id", F.lit(sample_id))
    return d.where(F.col("chrom").isin(chroms)) if chroms else d


def windows(spark: SparkSession, path, chroms: list[str] | None = None) -> DataFrame:
    """Windows with covariates by header name; GC is required."""
    d = spark.read.option("sep", "\t").option("header", True).csv(path)
    if "GC" not in d.columns:
        raise ValueError("the window table needs a GC column")
    names = {"#CHR": "chrom", "START": "start", "END": "stop", "GC": "gc", "MAP": "map", "REPLI": "repli"}
    d = d.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in d.columns])
    d = d.withColumns({c: F.col(c).cast("long") for c in ("start", "stop")} | {c: F.col(c).cast("double") for c in ("gc", "map", "repli") if c in d.columns})
    d = d.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("gc", "map", "repli") if c in d.columns})
    return d.where(F.col("chrom").isin(chroms)) if chroms else d


def gtf(spark: SparkSession, path, feature: str) -> DataFrame:
    """Records of one feature type as half-open intervals with gene_id; names get a chr prefix."""
    d = _tsv(spark, path, S.GTF).where(F.col("feature") == feature)
    return d.select(S.with_chr(F.col("chrom")).alias("chrom"), (F.col("start") - 1).alias("start"), "stop", F.regexp_extract("attributes", 'gene_id "([^"]+)"', 1).alias("gene_id"), F.monotonically_increasing_id().alias("row_id"))


def genes(spark: SparkSession, path) -> DataFrame:
    """The first record of each gene."""
    from locuslake.operators.counts import first_of

    return first_of(gtf(spark, path, "gene"), ["gene_id"], ["row_id"]).drop("row_id")


def exons(spark: SparkSession, path) -> DataFrame:
    return gtf(spark, path, "exon").drop("row_id")


def barcodes(spark: SparkSession, path, rep_id: str | None = None) -> DataFrame:
    """(barcode), named {barcode}_{rep_id} where a replicate is given."""
    d = spark.read.text(path).select(F.trim("value").alias("barcode")).where("barcode != ''")
    return d.withColumn("barcode", F.concat_ws("_", "barcode", F.lit(rep_id))) if rep_id else d


def barcode_map(spark: SparkSession, path) -> DataFrame:
    return _tsv(spark, path, "rep_id string, barcode string", header=True)


def matrix_market(spark: SparkSession, path) -> DataFrame:
    """(row_id, col_id, value) from 0, as the first line says: value is long for integer, double for real and 1 for pattern; of a symmetric
    or skew-symmetric matrix the other half comes too. Without such a line, or where it says no more, values are read as long.

    The line of sizes is the first without % of the file that begins so, told by its place; a plain file is read by many tasks.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")).alias("at"))
    said = raw.where(F.lower("value").startswith("%%matrixmarket")).select("file", F.split(F.lower(F.trim("value")), r"\s+").alias("words")).first()  # one line
    words = said["words"] if said and len(said["words"]) > 4 else ["", "matrix", "coordinate", "integer", "general"]
    if words[1:3] != ["matrix", "coordinate"] or words[3] not in ("integer", "real", "pattern") or words[4] not in ("general", "symmetric", "skew-symmetric"):
        raise ValueError(f"a matrix of kind {words[1:]} is not read")
    rows = raw.where("value not like '\\%%' and trim(value) != ''")
    first = rows.where(F.col("file") == said["file"]) if said else rows
    sizes = first.agg(F.min(F.struct("at", "file")).alias("s")).select(F.col("s.at").alias("_at"), F.col("s.file").alias("_file"))
    p = F.split(F.trim("value"), r"\s+")
    value = F.lit(1).cast("long") if words[3] == "pattern" else p[2].cast("double" if words[3] == "real" else "long")
    d = rows.join(F.broadcast(sizes), ~((F.col("at") == F.col("_at")) & (F.col("file") == F.col("_file"))))  # one row
    d = d.select((p[0].cast("long") - 1).alias("row_id"), (p[1].cast("long") - 1).alias("col_id"), value.alias("value"))
    if words[4] == "general":
        return d
    other = d.where("row_id != col_id").select(F.col("col_id").alias("row_id"), F.col("row_id").alias("col_id"), (-F.col("value") if words[4] == "skew-symmetric" else F.col("value")).alias("value"))
    return d.unionByName(other)


def npz(spark: SparkSession, path, name: str = "mat", rows: int = 4096, with_name: bool = False) -> DataFrame:
    """(row_id, col_id, value double; first, if asked for, file) of the cells other than 0 of numpy archives: a dense array `name`, or a matrix
    stored by rows (data, indices, indptr). An archive is read in one task and leaves it `rows` rows at a time."""
    import io

    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                held = np.load(io.BytesIO(content.as_py()), allow_pickle=False)
                if name not in held and bytes(held["format"].tobytes()).replace(b"\0", b"") != b"csr":
                    raise ValueError("a sparse archive must be stored by rows")
                n = len(held[name]) if name in held else len(held["indptr"]) - 1
                for a in range(0, n, rows):
                    if name in held:
                        part = np.atleast_2d(held[name])[a : a + rows] if held[name].ndim > 1 else held[name][a : a + rows, None]
                        i, j = np.nonzero(part)
                        value = part[i, j]
                    else:
                        ends = held["indptr"][a : a + rows + 1]
                        i, j, value = np.repeat(np.arange(len(ends) - 1), np.diff(ends)), held["indices"][ends[0] : ends[-1]], held["data"][ends[0] : ends[-1]]
                    yield pa.RecordBatch.from_arrays([pa.array((i + a).astype(np.int64)), pa.array(j.astype(np.int64)), pa.array(value.astype(np.float64)), pa.array([file] * len(i), pa.string())], ["row_id", "col_id", "value", "file"])

    d = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "row_id long, col_id long, value double, file string").where("value <> 0")
    return d.select(*(["file"] if with_name else []), "row_id", "col_id", "value")


def csr(spark: SparkSession, path: str, first: int | None = None, stop: int | None = None) -> DataFrame:
    """(row_id, col_id, value double) of the archives that writers.csr leaves below `path`; of rows first to stop - 1 alone, only the archives that hold some are opened."""
    path = path.rstrip("/")
    shards = spark.read.parquet(f"{path}/shards").where("cells > 0")
    low, high = first or 0, 1 << 62 if stop is None else stop
    shards = shards.where((F.col("first") < high) & (F.col("first") + F.col("rows") > low))
    cells = npz(spark, [f"{path}/{r['name']}" for r in shards.select("name").collect()], with_name=True) if shards.limit(1).count() else spark.createDataFrame([], "file string, row_id long, col_id long, value double")
    d = cells.withColumn("name", F.element_at(F.split("file", "/"), -1)).join(shards.select("name", F.col("first").alias("_first")), "name")
    return d.select((F.col("row_id") + F.col("_first")).alias("row_id"), "col_id", "value").where((F.col("row_id") >= low) & (F.col("row_id") < high))


def matrix(spark: SparkSession, path) -> DataFrame:
    """A long matrix as writers.matrix leaves it."""
    return spark.read.parquet(path)


def annotated_matrix(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """obs (barcodes), var (features) and x (barcode, feature_id, value) as writers.annotated_matrix leaves them."""
    return {part: spark.read.parquet(f"{folder}/{part}") for part in ("obs", "var", "x")}


def feature_matrix(spark: SparkSession, folder: str, rep_id: str | None = None, listed: DataFrame | None = None) -> DataFrame:
    """(barcode, feature_id, value) of a folder of matrix.mtx.gz, features.tsv.gz and barcodes.tsv.gz, features by row; of listed
    barcodes only, where there is a list (without replicate), named {barcode}_{rep_id} where a replicate is given."""
    cells = lines(spark, f"{folder}/barcodes.tsv.gz").select(F.col("row_id").alias("col_id"), F.trim("value").alias("barcode"))
    if listed is not None:
        cells = cells.join(listed.select("barcode").distinct(), "barcode", "left_semi")
    if rep_id:
        cells = cells.withColumn("barcode", F.concat_ws("_", "barcode", F.lit(rep_id)))
    kinds = lines(spark, f"{folder}/features.tsv.gz").select("row_id", F.split("value", "\t")[0].alias("feature_id"))
    return matrix_market(spark, f"{folder}/matrix.mtx.gz").join(cells, "col_id").join(kinds, "row_id").select("barcode", "feature_id", "value")


#: Where a fragments file may lie in a sample's folder, the first that is there.
FRAGMENT_FILES = ("atac_fragments.tsv.gz", "fragments.tsv.gz")


def fragments_of(spark: SparkSession, folder: str, whitelist: DataFrame | None = None) -> DataFrame:
    jvm = spark.sparkContext._jvm
    for name in FRAGMENT_FILES:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return fragments(spark, f"{folder}/{name}", whitelist)
    raise FileNotFoundError(f"none of {', '.join(FRAGMENT_FILES)} in {folder}")


def fragments(spark: SparkSession, path, whitelist: DataFrame | None = None) -> DataFrame:
    d = _tsv(spark, path, "chrom string, start long, stop long, barcode string, count long")
    return d.join(whitelist.select("barcode").distinct(), "barcode", "left_semi") if whitelist is not None else d


def eagle_map(spark: SparkSession, path) -> DataFrame:
    """(chrom, pos, cm) of a space-separated map with a header; chromosome 23 is X."""
    d = _tsv(spark, path, "chrom string, pos long, rate double, cm double", None, " ", True)
    return map_rows(d)


def map_rows(d: DataFrame) -> DataFrame:
    chrom = F.when(F.col("chrom").isin("23", "chr23"), "chrX").otherwise(S.with_chr(F.col("chrom")))
    return d.select(chrom.alias("chrom"), "pos", "cm").where(S.chrom_ord(F.col("chrom")).isNotNull())


def shapeit_map(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(chrom, pos, cm) of one tab-separated map for each chromosome."""
    return reduce(DataFrame.unionByName, [_tsv(spark, p, "pos long, rate double, cm double", None, "\t", True).select(F.lit(c).alias("chrom"), "pos", "cm") for c, p in paths.items()])


def samples(spark: SparkSession, path) -> DataFrame:
    d = spark.read.option("sep", "\t").option("header", True).csv(path)
    return d.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) for c in d.columns])


def annotations(spark: SparkSession, path, barcode: str = "Barcode", label: str = "Microregion_annotation") -> DataFrame:
    """(barcode, label): labels simplified, missing ones normal."""
    d = spark.read.option("sep", "\t").option("header", True).csv(path)
    return d.select(F.col(barcode).alias("barcode"), simplify_label(F.when(~F.col(label).isin("", "NA"), F.col(label))).alias("label"))


def gene_list(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("gene")).where("gene != ''")


def chains(spark: SparkSession, path: str) -> DataFrame:
    """The aligned blocks of a chain file, plain or gzip: chain_id, score, chrom, start, stop, to_chrom, to_start, to_stop, strand.

    A record of the scan is a chain, so that a plain file is read by many tasks. Places on the other strand are counted from its end
    there, and from the start here. Comments and empty lines are passed over; a chain whose blocks do not end where its header says is an error when read.
    """
    raw = spark.read.option("lineSep", "chain ").text(path).where(F.col("value").rlike(r"^\s*-?[0-9]+(\.[0-9]+)?\s+\S+\s+[0-9]+\s+\+"))
    lines = F.filter(F.transform(F.split("value", "\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("#"))
    d = raw.select(lines.alias("lines")).withColumn("h", F.split(F.get("lines", F.lit(0)), r"\s+"))
    word = lambda k: F.get("h", F.lit(k - 1))
    number = lambda k: word(k).cast("long")
    step = lambda x: F.transform(F.split(x, r"\s+"), lambda v: v.cast("long"))
    blocks = F.transform(F.slice("lines", F.lit(2), F.size("lines")), step)
    d = d.select(word(12).cast("long").alias("chain_id"), word(1).cast("double").alias("score"), word(2).alias("chrom"), number(5).alias("t0"), number(6).alias("t1"), word(7).alias("to_chrom"), number(8).alias("to_size"), word(9).alias("strand"), number(10).alias("q0"), number(11).alias("q1"), F.posexplode(blocks).alias("k", "b"))
    size, dt, dq = F.col("b")[0], F.coalesce(F.get("b", F.lit(1)), F.lit(0)), F.coalesce(F.get("b", F.lit(2)), F.lit(0))
    w = W.partitionBy("chain_id", "chrom", "t0", "to_chrom", "q0", "strand").orderBy("k")  # the blocks of one chain
    before = w.rowsBetween(W.unboundedPreceding, -1)
    d = d.withColumns({"start": F.col("t0") + F.coalesce(F.sum(size + dt).over(before), F.lit(0)), "_q": F.col("q0") + F.coalesce(F.sum(size + dq).over(before), F.lit(0)), "_last": F.lead("k").over(w).isNull()})
    d = d.withColumn("stop", F.col("start") + size).withColumn("_r", F.col("_q") + size)
    fine = ~F.col("_last") | ((F.col("stop") == F.col("t1")) & (F.col("_r") == F.col("q1")))
    d = d.withColumn("stop", F.when(fine, F.col("stop")).otherwise(F.raise_error(F.concat(F.lit("the blocks do not fill chain "), F.col("chain_id").cast("string"))).cast("long")))
    forward = F.col("strand") == "+"
    return d.select("chain_id", "score", "chrom", "start", "stop", "to_chrom", F.when(forward, F.col("_q")).otherwise(F.col("to_size") - F.col("_r")).alias("to_start"), F.when(forward, F.col("_r")).otherwise(F.col("to_size") - F.col("_q")).alias("to_stop"), "strand")
