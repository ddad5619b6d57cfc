"""Operator 3: line dedup by a fixed-depth log-template tree, in DataFrame functions only.

A line's path in the tree is its token count and its first ``depth`` tokens
with runs of digits generalised; the later tokens are cut into ``FIELDS``
stretches.  A leaf holds several templates: a template fixes half of the
stretches that hold tokens (rounded up) and leaves the others variable, so a
line follows one template for each such half, and a line that ends with its
path follows one.  A template that occurs in ``min_docs`` documents or more
recurs, and its lines are dropped everywhere but in the first document
(smallest id) that has it, so no content is lost altogether.

Only paths that enough documents share can hold a recurring template; the
templates of all other lines are never made.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import col
from ledgerlens.session import materialize

#: leading tokens in the path
DEPTH = 8
#: documents that make a template recurring
MIN_DOCS = 3
#: shorter lines never count as templates
MIN_TOKENS = 4
#: stretches into which the tokens after the path are cut
FIELDS = 4


def halves(held: int) -> list[tuple[int, ...]]:
    """Stretches that a template of a line with so many stretches fixes; the first stretches are those that hold tokens."""
    return list(combinations(range(held), -(-held // 2)))


def _lines(text: F.Column) -> F.Column:
    return F.split(text, "\n")


def _template(line: F.Column, depth: int) -> F.Column:
    """Token count, leaf and stretches of a line; tokens are parted by single blanks."""
    plain = F.regexp_replace(F.trim(line), "[0-9]+", "0")
    count = F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))) + 1
    head = F.substring_index(plain, " ", depth)
    # stretch i holds the tail's tokens i*step to (i+1)*step; prefixes of the tail cost no token array
    tail = F.substring(plain, F.length(head) + 2, F.length(plain))
    step = F.greatest(F.lit(1), F.ceil((count - depth) / F.lit(FIELDS))).cast("int")
    held = F.greatest(F.lit(0), F.ceil((count - depth) / step)).cast("int").alias("held")
    ends = [F.lit("")] + [F.call_function("substring_index", tail, F.lit(" "), step * (i + 1)) for i in range(FIELDS)]
    parts = [F.xxhash64(F.substring(ends[i + 1], F.length(ends[i]) + 1, F.length(plain))).alias(f"f{i}") for i in range(FIELDS)]
    return F.struct(count.alias("tokens"), F.xxhash64(count, head).alias("leaf"), held, F.struct(*parts).alias("fields"))


def line_table(df: DataFrame, id_col: str, text_col: str, depth: int = DEPTH, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``doc``, ``text_hash``, ``at``, ``leaf``, ``held``, ``fields`` of every line with ``min_tokens`` tokens or more."""
    lines = df.select(
        col(id_col).alias("doc"),
        F.xxhash64(col(text_col)).alias("text_hash"),
        F.posexplode(_lines(col(text_col))).alias("at", "line"),
    )
    made = lines.select("doc", "text_hash", "at", _template(F.col("line"), depth).alias("t"))
    return made.where(F.col("t.tokens") >= min_tokens).select("doc", "text_hash", "at", "t.leaf", "t.held", "t.fields")


def _followed() -> F.Column:
    """Hashes of all templates that a line follows."""
    made = F.array(F.col("leaf"))
    for held in range(1, FIELDS + 1):
        kept = [F.xxhash64("leaf", F.lit(held), F.lit(str(half)), *[f"fields.f{i}" for i in half]) for half in halves(held)]
        made = F.when(F.col("held") == held, F.array(*kept)).otherwise(made)
    return made


def drop_templates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = DEPTH,
    min_docs: int = MIN_DOCS,
    min_tokens: int = MIN_TOKENS,
) -> DataFrame:
    """The table with recurring lines taken out of its texts, and ``n_lines``, ``n_dropped``.

    Documents are told apart by id; rows that repeat an id count as one document.
    A null text stays null with 0 lines; an empty one has one empty line, which is
    too short to drop.  Of equal ids or lines no choice depends on partitions.
    All columns of the input are kept; input columns named ``n_lines`` or
    ``n_dropped`` are replaced.
    """
    columns = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    lines = materialize(line_table(df, id_col, text_col, depth, min_tokens), "lines")
    # a document's own repeats are one; the count over documents combines on the map side
    shared = lines.groupBy("leaf", "doc").agg(F.lit(1).alias("one")).groupBy("leaf").agg(F.count("one").alias("docs"))
    shared = materialize(shared.where(F.col("docs") >= min_docs).select("leaf"), "leaves")
    followed = lines.join(shared, "leaf").select("doc", "text_hash", "at", F.explode(_followed()).alias("template"))
    followed = materialize(followed, "templates")
    recurring = (
        followed.groupBy("template", "doc").agg(F.lit(1).alias("one"))
        .groupBy("template").agg(F.count("one").alias("docs"), F.min("doc").alias("owner"))
    )
    recurring = materialize(recurring.where(F.col("docs") >= min_docs).select("template", "owner"), "recurring")
    gone = (
        followed.join(recurring, "template")
        .where(~F.col("doc").eqNullSafe(F.col("owner")))
        .groupBy(F.col("doc").alias("__llm_doc"), F.col("text_hash").alias("__llm_text"))
        .agg(F.collect_set("at").alias("__llm_gone"))
    )
    split = _lines(col(text_col))
    kept = F.array_join(F.filter(split, lambda x, i: ~F.array_contains("__llm_gone", i)), "\n")
    joined = df.select(*[col(c) for c in columns]).join(
        gone.hint("shuffle_hash"),
        col(id_col).eqNullSafe(F.col("__llm_doc")) & (F.xxhash64(col(text_col)) == F.col("__llm_text")),
        "left",
    )
    fields = [
        F.when(F.col("__llm_gone").isNull(), col(c)).otherwise(kept).alias(c) if c == text_col else col(c) for c in columns
    ]
    n_lines = F.coalesce(F.length(col(text_col)) - F.length(F.replace(col(text_col), F.lit("\n"), F.lit(""))) + 1, F.lit(0))
    return joined.select(
        *fields, n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("__llm_gone"), F.lit(0)).cast("long").alias("n_dropped")
    )


def _sql_templates() -> str:
    """The templates of a line as lists: the stretches that are fixed, with their numbers."""
    cases = [
        f"WHEN held = {held} THEN [" + ", ".join("[" + ", ".join(f"'{i}=' || f{i}" for i in half) + "]" for half in halves(held)) + "]"
        for held in range(1, FIELDS + 1)
    ]
    return f"CASE {' '.join(cases)} ELSE [['']] END"


# The same in SQL over the view ``documents``, with texts in place of hashes.
SQL = f"""
WITH lines AS (
  SELECT doc_id, text, i - 1 AS pos, regexp_replace(trim(parts[i]), '[0-9]+', '0', 'g') AS plain
  FROM (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
       unnest(range(1, len(parts) + 1)) AS r(i)),
tokens AS (
  SELECT doc_id, text, pos, string_split(plain, ' ') AS t FROM lines),
cut AS (
  SELECT doc_id, text, pos, len(t) AS n, array_to_string(t[1:{DEPTH}], ' ') AS head,
         t[{DEPTH + 1}:] AS tail, greatest(1, CAST(ceil((len(t) - {DEPTH}) / {FIELDS}.0) AS BIGINT)) AS step
  FROM tokens WHERE len(t) >= {MIN_TOKENS}),
fields AS (
  SELECT doc_id, text, pos, n, head, greatest(0, CAST(ceil((n - {DEPTH}) / CAST(step AS DOUBLE)) AS BIGINT)) AS held,
         {", ".join(f"array_to_string(tail[{i} * step + 1:{i + 1} * step], ' ') AS f{i}" for i in range(FIELDS))} FROM cut),
followed AS (
  SELECT doc_id, text, pos, n, head, unnest({_sql_templates()}) AS template FROM fields),
recurring AS (
  SELECT n, head, template, min(doc_id) AS owner FROM followed
  GROUP BY n, head, template HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
gone AS (
  SELECT DISTINCT doc_id, text, pos FROM followed JOIN recurring USING (n, head, template) WHERE doc_id <> owner),
kept AS (
  SELECT doc_id, text, string_agg(parts[i], chr(10) ORDER BY i) AS rest
  FROM (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents), unnest(range(1, len(parts) + 1)) AS r(i)
  WHERE (doc_id, text, i - 1) NOT IN (SELECT doc_id, text, pos FROM gone)
  GROUP BY doc_id, text),
counts AS (SELECT doc_id, text, count(*) AS n_dropped FROM gone GROUP BY doc_id, text)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0) AS n_lines, coalesce(c.n_dropped, 0) AS n_dropped,
       CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(k.rest, '')) END AS kept_md5
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id AND k.text = d.text
LEFT JOIN counts c ON c.doc_id = d.doc_id AND c.text = d.text
"""
