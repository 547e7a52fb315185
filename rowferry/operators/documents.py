"""Documents, links, attachments: match, plan, remap, count."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.functions.names import every

from rowferry.functions.cells import strip
from rowferry.functions.text import as_base64, safe_file_name
from rowferry.operators.matching import SOURCE_ID, TARGET_ID
from rowferry.operators.ranking import first_per_key, last_per_key, rank_rows


def match_value(external: Column, title: Column) -> Column:
    """The external value, or the title where there is none; in lower case, blanks trimmed."""
    text = F.coalesce(external.cast("string"), title.cast("string"))
    return F.nullif(F.lower(strip(text)), F.lit(""))


def target_documents(links: DataFrame, versions: DataFrame, external: str, link_order: Sequence[str]) -> DataFrame:
    """(parent, value) to document: the first linked document of the target wins."""
    by_doc = versions.select(
        F.col("doc_id").alias("_doc"), match_value(F.col(external), F.col("title")).alias("_value"), F.col("version_id").alias("_v")
    )
    by_doc = last_per_key(by_doc, ["_doc"], ["_v"]).drop("_v").where("_value IS NOT NULL")
    order = [F.col(o).alias(f"_o{i}") for i, o in enumerate(link_order)]
    names = [f"_o{i}" for i in range(len(link_order))]
    slim = links.select(F.col("parent_id").alias("_tparent"), F.col("doc_id").alias("_tdoc"), *order)
    joined = slim.join(by_doc, F.col("_tdoc") == F.col("_doc")).drop("_doc")
    return first_per_key(joined, ["_tparent", "_value"], names).select("_tparent", F.col("_value").alias("_tvalue"), "_tdoc")


def match_documents(
    links: DataFrame,
    versions: DataFrame,
    parents: DataFrame,
    target_links: DataFrame,
    target_versions: DataFrame,
    external: str,
    target_link_order: Sequence[str],
) -> DataFrame:
    """Every source link with a mapped parent, with the target document if there is one.

    Links are (link_id, parent_id, doc_id), versions (version_id, doc_id, title, ...); the
    last version of a document counts.
    """
    latest = last_per_key(
        versions.select("doc_id", F.col("version_id").alias("_v"), match_value(F.col(external), F.col("title")).alias("match_value")),
        ["doc_id"],
        ["_v"],
    ).drop("_v")
    pairs = parents.select(F.col(SOURCE_ID).alias("parent_id"), F.col(TARGET_ID).alias("target_parent_id"))
    mapped = links.join(pairs, "parent_id").join(latest, "doc_id").where("match_value IS NOT NULL")
    known = target_documents(target_links, target_versions, external, target_link_order)
    hit = (F.col("target_parent_id") == F.col("_tparent")) & (F.col("match_value") == F.col("_tvalue"))
    return mapped.join(known, hit, "left").select(
        *links.columns, "target_parent_id", "match_value", F.col("_tdoc").alias("target_doc_id")
    )


def is_newer(source: str, target: str) -> Column:
    """A new version is due when the kind, the link, its date or the checksum changed."""

    def col(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    source_url = F.coalesce(F.length(col(source, "url")) > 0, F.lit(False))
    target_url = F.coalesce(F.length(col(target, "url")) > 0, F.lit(False))
    link_changed = (col(source, "modified") > col(target, "modified")) | ~col(source, "url").eqNullSafe(
        col(target, "url")
    )
    return F.coalesce(
        F.when(source_url != target_url, True)
        .when(source_url, link_changed)
        .otherwise(~col(source, "checksum").eqNullSafe(col(target, "checksum"))),
        F.lit(False),
    )


def version_plan(matched: DataFrame, versions: DataFrame, target_versions: DataFrame) -> DataFrame:
    """(doc_id, target_doc_id, action): ``new_document``, ``new_version`` or ``keep``.

    A document counts once, with the first target document any of its links found.
    """
    docs = matched.groupBy("doc_id").agg(
        F.min_by("target_doc_id", F.when(F.col("target_doc_id").isNotNull(), F.col("link_id"))).alias("target_doc_id")
    )
    detail = ["url", "modified", "checksum"]

    def latest(df: DataFrame, id_name: str, side: str) -> DataFrame:
        slim = df.select(F.col("doc_id").alias(id_name), F.col("version_id").alias("_v"), F.struct(*detail).alias(side))
        return last_per_key(slim, [id_name], ["_v"]).drop("_v")

    joined = docs.join(latest(versions, "doc_id", "_s"), "doc_id").join(
        latest(target_versions, "_tid", "_t"), F.col("target_doc_id") == F.col("_tid"), "left"
    )
    action = (
        F.when(F.col("_tid").isNull(), "new_document").when(is_newer("_s", "_t"), "new_version").otherwise("keep")
    )
    return joined.select("doc_id", "target_doc_id", action.alias("action"))


@dataclass(frozen=True)
class FilePlan:
    """What to write."""

    versions_to_insert: DataFrame
    versions_to_update: DataFrame
    links_to_insert: DataFrame


def file_plan(versions: DataFrame, links: DataFrame, operation: str, matched: DataFrame | None = None) -> FilePlan:
    """Versions and links to insert and to update, each document once.

    Insert takes everything. Update and Upsert go by ``matched`` (J29): a known document gets
    the version of its first link, an unknown one is inserted with its links by Upsert only.
    """
    first = first_per_key(versions, ["doc_id"], ["version_id"])
    last = last_per_key(versions, ["doc_id"], ["version_id"])
    if operation not in ("Update", "Upsert"):
        nothing = first.withColumn("target_doc_id", F.col("doc_id")).where(F.lit(False))
        return FilePlan(first, nothing, links)
    known = matched.where("target_doc_id IS NOT NULL").select("target_doc_id", "doc_id", "link_id")
    chosen = first_per_key(known, ["target_doc_id"], ["link_id"]).drop("link_id")
    updates = last.join(chosen, "doc_id").select(*versions.columns, "target_doc_id")
    unknown = matched.where("target_doc_id IS NULL" if operation == "Upsert" else "false")
    inserts = last.join(unknown.select("doc_id").distinct(), "doc_id", "left_semi")
    return FilePlan(inserts, updates, unknown.select(*links.columns))


def remap_links(links: DataFrame, parents: DataFrame, documents: DataFrame) -> DataFrame:
    """Parent and document ids of a link both become target ids; else the row is dropped."""
    p = parents.select(F.col(SOURCE_ID).alias("_sp"), F.col(TARGET_ID).alias("_tp"))
    d = documents.select(F.col(SOURCE_ID).alias("_sd"), F.col(TARGET_ID).alias("_td"))
    joined = links.join(p, F.col("parent_id") == F.col("_sp")).join(d, F.col("doc_id") == F.col("_sd"))
    new = {"parent_id": F.col("_tp"), "doc_id": F.col("_td")}
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in links.columns])


def remap_attachments(rows: DataFrame, parents: DataFrame, parent_column: str = "parent_id", body: str | None = None) -> DataFrame:
    """Attachments and notes of mapped parents. Bodies become base64, empty ones go."""
    p = parents.select(F.col(SOURCE_ID).alias("_sp"), F.col(TARGET_ID).alias("_tp"))
    joined = rows.join(p, F.col(parent_column) == F.col("_sp"))
    new = {parent_column: F.col("_tp")}
    if body:
        joined = joined.where(F.length(body) > 0)
        new[body] = as_base64(F.col(body))
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in rows.columns])


def rows_of_parents(rows: DataFrame, parent_column: str, parents: DataFrame, parent_id: str) -> DataFrame:
    """Documents, attachments or notes of the given parents."""
    ids = parents.select(F.col(parent_id).alias("_pid")).where("_pid IS NOT NULL").distinct()
    return rows.join(ids, F.col(parent_column) == F.col("_pid"), "left_semi")


def new_document_ids(inserted: DataFrame, target_versions: DataFrame) -> DataFrame:
    """Source document to target document, through the inserted version.

    ``inserted`` is (doc_id, version_id) with the new version's id.
    """
    known = target_versions.select(F.col("version_id").alias("_v"), F.col("doc_id").alias(TARGET_ID))
    return inserted.join(known, F.col("version_id") == F.col("_v")).select(F.col("doc_id").alias(SOURCE_ID), TARGET_ID)


def file_names(
    df: DataFrame, table: str, title: str, path: str, order_by: Sequence[str], name: str = "file_name"
) -> DataFrame:
    """``title-0001.ext``, numbered per (table, name)."""
    file = F.regexp_extract(F.coalesce(F.col(path), F.lit("")), r"([^/\\]*)$", 1)
    extension = F.nullif(F.regexp_extract(file, r"^.+(\.[^.]*)$", 1), F.lit(""))
    stem = F.coalesce(F.nullif(F.regexp_extract(file, r"^(.+)\.[^.]*$", 1), F.lit("")), file)
    base = F.coalesce(F.nullif(F.col(title), F.lit("")), F.nullif(stem, F.lit("")), F.lit(table))
    named = df.withColumn("_base", safe_file_name(base)).withColumn("_ext", F.coalesce(extension, F.lit(".bin")))
    ranked = rank_rows(named, ["_base"], order_by)
    number = F.lpad(F.col("_rn").cast("string"), 4, "0")
    # Past 9999 the number is longer, it is never cut.
    number = F.when(F.col("_rn") > 9999, F.col("_rn").cast("string")).otherwise(number)
    return ranked.withColumn(name, F.concat("_base", F.lit("-"), number, "_ext")).select(*every(df), name)


def transfer_counts(parents: DataFrame, counted: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per mapped parent for each named frame; parents without rows count 0."""
    out = parents.select(F.col(SOURCE_ID).alias("parent_id"), F.col(TARGET_ID).alias("target_parent_id"))
    for name, (df, column) in counted.items():
        per_parent = df.groupBy(F.col(column).alias("_p")).agg(F.count("*").alias(name))
        out = out.join(per_parent, F.col("parent_id") == F.col("_p"), "left").drop("_p")
    return out.na.fill(0, list(counted))
