"""Documents."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rowferry.operators import documents
from suite import fixtures as X
from suite.joins import MATCHED, matched
from suite.registry import Tables, case


@case(
    "m16_document_version_plan",
    X.with_ctes(
        X.DOCS, MATCHED,
        select="""SELECT d.doc_id, d.target_doc_id, CASE WHEN g.doc_id IS NULL THEN 'new_document'
    WHEN coalesce(length(s.url) > 0, FALSE) <> coalesce(length(g.url) > 0, FALSE) THEN 'new_version'
    WHEN coalesce(length(s.url) > 0, FALSE) THEN CASE WHEN s.modified > g.modified OR s.url IS DISTINCT FROM g.url THEN 'new_version' ELSE 'keep' END
    WHEN s.checksum IS DISTINCT FROM g.checksum THEN 'new_version' ELSE 'keep' END AS action
  FROM (SELECT doc_id, min_by(target_doc_id, CASE WHEN target_doc_id IS NOT NULL THEN link_id END) AS target_doc_id FROM matched GROUP BY doc_id) d
  JOIN doc_versions s ON d.doc_id = s.doc_id LEFT JOIN doc_versions_target g ON d.target_doc_id = g.doc_id""",
    ),
)
def m16(t: Tables) -> DataFrame:
    return documents.version_plan(matched(t), X.doc_versions(t), X.doc_versions_target(t))


def plan(t: Tables, operation: str) -> documents.FilePlan:
    return documents.file_plan(X.doc_versions(t), X.doc_links(t), operation, matched(t))


@case(
    "m17_versions_to_insert",
    X.with_ctes(X.DOCS, MATCHED, select="SELECT doc_id, version_id FROM doc_versions WHERE doc_id IN (SELECT doc_id FROM matched WHERE target_doc_id IS NULL)"),
)
def m17_insert(t: Tables) -> DataFrame:
    return plan(t, "Upsert").versions_to_insert.select("doc_id", "version_id")


@case(
    "m17_versions_to_update",
    X.with_ctes(
        X.DOCS, MATCHED,
        select="SELECT m.doc_id, v.version_id, m.target_doc_id FROM (SELECT target_doc_id, min_by(doc_id, link_id) AS doc_id FROM matched WHERE target_doc_id IS NOT NULL GROUP BY 1) m JOIN doc_versions v ON m.doc_id = v.doc_id",
    ),
)
def m17_update(t: Tables) -> DataFrame:
    return plan(t, "Upsert").versions_to_update.select("doc_id", "version_id", "target_doc_id")


@case(
    "m17_links_to_insert",
    X.with_ctes(X.DOCS, MATCHED, select="SELECT link_id, parent_id, doc_id, share FROM matched WHERE target_doc_id IS NULL"),
)
def m17_links(t: Tables) -> DataFrame:
    return plan(t, "Upsert").links_to_insert


@case(
    "a8_document_transfer_counters",
    X.with_ctes(
        X.CUSTOMER_TARGET, X.CUSTOMER_XREF, X.DOC_LINKS,
        select="""SELECT x.source_id AS parent_id, x.target_id AS target_parent_id, coalesce(f.n, 0) AS files, coalesce(a.n, 0) AS attachments FROM customer_xref x
  LEFT JOIN (SELECT parent_id, count(*) AS n FROM doc_links GROUP BY 1) f ON x.source_id = f.parent_id LEFT JOIN (SELECT page_id AS parent_id, count(*) AS n FROM pages GROUP BY 1) a ON x.source_id = a.parent_id""",
    ),
)
def a8(t: Tables) -> DataFrame:
    return documents.transfer_counts(X.customer_xref(t), {"files": (X.doc_links(t), "parent_id"), "attachments": (t.pages, "page_id")})
