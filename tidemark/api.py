"""Read-only queries over a published package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import lineage as graph
from .operators.revisions import fact_view
from .operators.validate import manifest_matches, no_future, primary_key, report
from .operators.validate import projected as projected_columns
from .operators.validate import references as orphans
from .sources import dataset, package


class Evidence:
    """A package at a path; every method returns a lazy DataFrame."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self, name: str) -> DataFrame:
        return package.read_table(self.spark, self.path, name)

    def company(self, code: str | None = None, name: str | None = None, entity: str | None = None) -> DataFrame:
        """Companies by code, entity, or part of a name in any case (all that fit: names aren't keys)."""
        return company(self.table("entities"), self.table("name_grams"), code, name, entity)

    def facts(self, entity: str, as_of=None, replay: str = "public_reconstruction", snapshot=None) -> DataFrame:
        docs = self.table("documents").where(F.col("entity_id") == entity)
        facts = self.table("facts").join(docs.select("doc_id"), "doc_id", "left_semi")
        last = F.current_timestamp() if snapshot is None else F.lit(snapshot).cast("timestamp")
        decision = self.spark.range(1).select(F.lit("asked").alias("decision_id"), (last if as_of is None else F.lit(as_of).cast("timestamp")).alias("cutoff"), last.alias("snapshot"))
        return fact_view(facts, docs, decision, True, replay)

    def filings(self, entity: str) -> DataFrame:
        return self.table("documents").where(F.col("entity_id") == entity)

    def joins(self, entity: str) -> DataFrame:
        return self.table("joins").where(F.col("entity_id") == entity)

    def compare(self, doc_id: str) -> DataFrame:
        return self.table("comparisons").where(F.col("doc_id") == doc_id)

    def lineage(self, node: str) -> tuple[DataFrame, DataFrame]:
        return graph.walk(self.spark.createDataFrame([(node,)], "node string"), self.table("lineage"))

    def failures(self, doc_id: str | None = None, reason: str | None = None) -> DataFrame:
        rows = self.table("failures")
        rows = rows if doc_id is None else rows.where(F.col("doc_id") == doc_id)
        return rows if reason is None else rows.where(F.col("missing_reason") == reason)

    def validate(self, keys: dict[str, list[str]], references: tuple = (), projected: dict[str, list[str]] | None = None, required: tuple = (), joins: str | None = None) -> DataFrame:
        """(check, violations): primary keys, columns against payloads, references (table, column, table, key) to known rows, required edges (table, kind, column,
        kind, column, relation) in the lineage, PASS rows of a table of joins, and the manifest."""
        manifest = self.spark.read.parquet(f"{self.path}/snapshot_id={package.current(self.spark, self.path)}/_manifest")

        def named(rows: DataFrame, table: str) -> DataFrame:
            return rows.withColumn("check", F.concat(F.col("check"), F.lit(f":{table}")))

        checks = [named(primary_key(self.table(t), k), t) for t, k in keys.items()]
        checks += [named(projected_columns(self.table(t), c), t) for t, c in (projected or {}).items()]
        checks += [named(orphans(self.table(t), c, self.table(other), k), t) for t, c, other, k in references]
        for t, kind, column, other, target, relation in required:
            lost = graph.missing_edges(graph.edge(self.table(t), kind, column, other, target, relation), self.table("lineage"))
            checks.append(lost.agg(F.count("*").alias("violations")).select(F.lit(f"required_edge:{relation}").alias("check"), "violations"))
        if joins:
            checks.append(named(no_future(self.table(joins)), joins))
        return report([*checks, manifest_matches(manifest, package.actual(self.spark, self.path))])


class Dataset(Evidence):
    """A package that `publish_dataset` wrote; rows come from its payloads, nodes of the lineage are `table:id`."""

    NAMES = {"facts": "canonical_facts", "joins": "pit_join_rows", "comparisons": "derived_source_links"}
    #: Where the lineage of each kind of id begins.
    STARTS = {"fact_id": "canonical_facts", "row_id": "pit_join_rows", "source_row_id": "derived_source_rows", "comparison_id": "derived_source_links"}

    def table(self, name: str) -> DataFrame:
        rows = package.read_table(self.spark, self.path, self.NAMES.get(name, name))
        return dataset.edges_of(rows) if name == "lineage" else dataset.unpacked(rows)

    def about(self, part: str) -> DataFrame:
        """The current snapshot's `_about`, `_checks`, `_manifest` or `_inputs`."""
        return self.spark.read.parquet(f"{self.path}/snapshot_id={package.current(self.spark, self.path)}/{part}")

    def company(self, code: str | None = None, name: str | None = None, entity: str | None = None) -> DataFrame:
        return company(package.entity_members(self.table("documents")), None, code, name, entity)

    def facts(self, entity: str, as_of=None, replay: str = "public_reconstruction", snapshot=None) -> DataFrame:
        """Within the package's own cutoff unless another is named; an entity that the package doesn't have gives one row that says so."""
        last = self.about("_about").first()["cutoff"] if snapshot is None else snapshot
        if self.filings(entity).limit(1).count():
            return super().facts(entity, as_of, replay, last)
        return super().facts(entity, as_of, replay, last).unionByName(self.spark.range(1).select(F.lit("asked").alias("decision_id"), F.lit("entity_not_in_snapshot").alias("missing_reason")), allowMissingColumns=True)

    def failures(self, doc_id: str | None = None, reason: str | None = None) -> DataFrame:
        rows = self.table("failures")
        rows = rows if doc_id is None else rows.where(F.col("doc_id") == doc_id)
        return rows if reason is None else rows.where(F.col("reason") == reason)

    def lineage_of(self, kind: str, value: str) -> tuple[DataFrame, DataFrame]:
        """(nodes with hops, edges) from a fact_id, row_id, comparison_id or source_row_id; a source row begins at itself and at all its comparisons."""
        starts = self.table(self.STARTS[kind]).where(F.col(kind) == value).select(F.concat(F.lit(f"{self.STARTS[kind]}:"), kind).alias("node"))
        if kind == "source_row_id":
            own = self.table("comparisons").where(F.col(kind) == value)
            starts = starts.union(own.select(F.concat(F.lit("derived_source_links:"), "comparison_id")))
        return graph.walk(starts.distinct(), self.table("lineage"))

    def validate(self) -> DataFrame:
        """(check, violations) of all the package's checks, made anew over what stands there."""
        tables = {n: package.read_table(self.spark, self.path, n) for n in dataset.TABLES}
        return dataset.checks(tables).union(manifest_matches(self.about("_manifest"), package.actual(self.spark, self.path)))


def company(members: DataFrame, grams: DataFrame | None = None, code: str | None = None, name: str | None = None, entity: str | None = None) -> DataFrame:
    """The rows of members(entity_id, kind, value) of the companies with a code, an entity id or a part of a name; grams are the names' posting lists."""
    if code is not None:
        hits = members.where((F.col("kind") == "code") & (F.col("value") == code)).select("entity_id")
    elif entity is not None:
        hits = members.where(F.col("entity_id") == entity).select("entity_id")
    else:
        asked = members.sparkSession.createDataFrame([(name or "",)], "query string")
        found = package.find_names(package.name_grams(members) if grams is None else grams, asked).select(F.col("name").alias("value"))
        hits = members.where("kind = 'name'").join(found, "value", "left_semi").select("entity_id")
    return members.join(hits.distinct(), "entity_id", "left_semi")
