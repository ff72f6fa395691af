"""Writers: each output is replaced as a whole, in one commit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_corpus(corpus: DataFrame, path: str, as_json: bool = False) -> None:
    writer = corpus.write.mode("overwrite")
    writer.json(path) if as_json else writer.parquet(path)


def write_raw(raw: DataFrame, path: str, html_path: str | None = None) -> None:
    """Raw elements in identifier order; their HTML, if asked for, partitioned by source, one row an element."""
    raw.orderBy("identifier").write.mode("overwrite").parquet(path)
    if html_path:
        raw.select("sourceName", "identifier", "htmlContent").write.mode("overwrite").partitionBy("sourceName").parquet(html_path)


def write_normalized(elements: DataFrame, path: str) -> None:
    """All normalised elements in one commit; a run that stops leaves what was there before."""
    elements.write.mode("overwrite").parquet(path)


def write_errors(errors: DataFrame, path: str) -> None:
    errors.write.mode("overwrite").json(path)


def write_vocabulary(vocabulary: DataFrame, path: str) -> None:
    """Clusters as JSON lines, sorted over all files by kind and order."""
    vocabulary.select("kind", "canonical", "variants", "parent", "ord").orderBy("kind", "ord").write.mode("overwrite").json(path)


def write_graph(nodes: DataFrame, edges: DataFrame, meta: DataFrame, folder: str) -> DataFrame:
    """Write a graph and return its summary: nodes and edges by type."""
    nodes.write.mode("overwrite").parquet(f"{folder}/nodes")
    edges.write.mode("overwrite").parquet(f"{folder}/edges")
    meta.write.mode("overwrite").parquet(f"{folder}/meta")
    spark = nodes.sparkSession
    counts = [spark.read.parquet(f"{folder}/{kind}").groupBy("type").agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind)) for kind in ("nodes", "edges")]
    return counts[0].unionByName(counts[1])


def write_overrides(overrides: DataFrame, path: str) -> None:
    """The list of overrides, which people keep by hand, as one ``{version, overrides}`` text."""
    each = F.struct("ord", F.to_json(F.struct(*(c for c in overrides.columns if c != "ord"))).alias("o"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(each)), lambda x: x["o"]), ",\n")
    overrides.agg(F.concat(F.lit('{"version":1,"overrides":['), listed, F.lit("]}")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_state(state: DataFrame, path: str) -> None:
    """Run counters and input hashes, one row a stage."""
    state.coalesce(1).write.mode("overwrite").json(path)


def merge_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """Stages of ``new`` replace those of ``old``."""
    return new.unionByName(old.join(new.select("stage"), "stage", "left_anti"))


def as_json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON text, for a server to send."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))
