"""One query for each operator, over the whole of its table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketeer.llm import (
    anchors,
    centroids,
    decontaminate,
    factors,
    licenses,
    mixing,
    packing,
    pages,
    quality,
    repair,
    secrets,
    simhash,
    suffixdedup,
)


def _table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words the mix takes of every document."""
    documents = _table(spark, folder, "documents", "doc_id", "source", "text")
    return mixing.plan_mix(documents).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )


def op2_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    found = pages.main_text(_table(spark, folder, "pages", "page_id", "url", "html"))
    return found.select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op3_anchors(spark: SparkSession, folder: str) -> DataFrame:
    """What stays of every document without the 20-word windows that also start earlier."""
    found = anchors.remove_repeated_runs(_table(spark, folder, "documents", "doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts, base verdict and verdict with the model, for every document."""
    documents = _table(spark, folder, "documents", "doc_id", "text")
    model = quality.fit(documents, _table(spark, folder, "labels", "doc_id", "quality"))
    found = quality.assess(documents, model)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), *quality.COUNTS, "base_failed", "kept", "probability"
    )


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases of every document, and the labels of phrases and templates."""
    found = licenses.license_scan(_table(spark, folder, "documents", "doc_id", "text"))
    named = lambda *lists: F.array_join(F.array_sort(F.array_distinct(F.transform(F.concat(*lists), lambda s: s["label"]))), ",")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        named("base").alias("base_labels"),
        named("base", "matches").alias("labels"),
        "score",
    )


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    texts = _table(spark, folder, "documents", "doc_id", "text")
    found = secrets.find_secrets(texts, carry=["doc_id"])
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op7_factors(spark: SparkSession, folder: str) -> DataFrame:
    """A quality score for every document, learned from two thirds of the labelled ones."""
    documents = _table(spark, folder, "documents", "doc_id", "text", "n_chars")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    labels = _table(spark, folder, "labels", "doc_id", "quality")
    machine = factors.fit(documents, labels, where=remainder != 1)
    found = factors.score(documents, machine)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    ).select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside a benchmark window, and the items found."""
    found = decontaminate.contamination(
        _table(spark, folder, "documents", "doc_id", "text"),
        _table(spark, folder, "benchmark", "item_id", "text"),
    )
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        decontaminate.item_digest(F.col("item_ids")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprint of every document and the smallest document its links lead to."""
    found = simhash.near_duplicates(_table(spark, folder, "documents", "doc_id", "text"))
    return found.select(
        F.col("key").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op10_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """What stays of every document without the 400-byte strings that also stand elsewhere."""
    found = suffixdedup.remove_repeats(_table(spark, folder, "documents", "doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after damage by a hash of its rows."""
    turns = _table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    return repair.repairs(repair.damage(turns)).withColumnRenamed("id", "conv_id")


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Where every piece of every document stands in sequences of 4,096 tokens."""
    import public_tokenizers

    documents = _table(spark, folder, "documents", "doc_id", "text")
    found = packing.pack(documents, str(public_tokenizers.path("word_bpe_49k.json")))
    return found.select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest of 16 centroids of every vector, after three rounds."""
    vectors = _table(spark, folder, "embeddings", "vec_id", "embedding")
    found, final = centroids.cluster(vectors)
    return found.join(F.broadcast(centroids.inertias(found)), "cluster").select(
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        centroids.digests(final).alias("centroid_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_pages": op2_pages,
    "op3_anchors": op3_anchors,
    "op4_quality": op4_quality,
    "op5_licenses": op5_licenses,
    "op6_secrets": op6_secrets,
    "op7_factors": op7_factors,
    "op8_decontaminate": op8_decontaminate,
    "op9_simhash": op9_simhash,
    "op10_suffixes": op10_suffixes,
    "op11_repair": op11_repair,
    "op12_packing": op12_packing,
    "op13_centroids": op13_centroids,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _rounds_sql(rounds: int) -> str:
    """The steps from centroids c0 to assignments and centroids of every later round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS MATERIALIZED (
            SELECT r, min({{'d': d, 'k': k}}) AS best FROM (
                SELECT r, k, list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
                FROM vectors x, c{i} c)
            GROUP BY r
        )""")
        if i < rounds:
            steps.append(f"""
        m{i} AS (
            SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
                SELECT best.k AS k, i, sum(v[i]) AS s, count(*) AS n
                FROM vectors JOIN a{i} USING (r), range(1, 65) t(i) GROUP BY ALL)
            GROUP BY k
        ),
        c{i + 1} AS MATERIALIZED (
            SELECT k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (k)
        )""")
    return ",".join(steps)


# Sequences of one or two insertions that lead from one state of the pattern to another, and the
# states behind the opening turn (1), a user turn (2) and an assistant turn (3).
_INSERTED = "(0,0,0,''),(1,1,0,''),(2,2,0,''),(3,3,0,''),(0,2,3,'I'),(1,2,3,'I'),(3,2,3,'I'),(2,3,3,'I'),(0,3,6,'II'),(1,3,6,'II'),(2,2,6,'II'),(3,3,6,'II')"
_STEPS = "('s',0,1),('u',0,2),('u',1,2),('u',3,2),('a',2,3)"
_VISIBLE = r"'[^\x20\x09-\x0D]'"

ORACLES: dict[str, str] = {
    # The shortest way through (row, state), one row a step, on the input's rows after damage.
    "op11_repair": rf"""
        WITH RECURSIVE hashed AS (
            SELECT *, xor(list_reduce(
                list_transform(range(1, length(h) + 1), lambda i: CAST(ascii(substr(h, i, 1)) AS BIGINT)),
                lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
                4294967295), 4294967295) % 20 AS fault
            FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS h
                  FROM conversations)
        ),
        damaged AS (
            SELECT conv_id, turn,
                   CASE WHEN fault = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
                   CASE WHEN fault = 1 THEN ''
                        WHEN fault = 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text
            FROM hashed, (VALUES (1), (2)) copies(copy) WHERE fault != 0 AND (copy = 1 OR fault = 3)
        ),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
        ),
        judged AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, {_VISIBLE}) THEN 'b'
                           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                           WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 't' ELSE '' END AS fault,
                   substr(role, 1, 1) AS initial,
                   lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
            FROM placed
        ),
        counted AS (
            SELECT conv_id, count(*) AS n,
                   coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
                   count(*) FILTER (fault = 't') AS truncated,
                   count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv_id
        ),
        steps(role, p, q) AS (VALUES {_STEPS}),
        inserted(p, q, cost, audit) AS (VALUES {_INSERTED}),
        edits AS (
            SELECT conv_id, i, p, p AS q, 4 AS cost, 'D' AS audit FROM judged, (VALUES (0), (1), (2), (3)) t(p)
            UNION ALL
            SELECT conv_id, i, p, q, 3 * CAST(fault = 't' AS INTEGER), 'K'
            FROM judged JOIN steps ON steps.role = initial WHERE fault NOT IN ('b', 'd')
            UNION ALL
            SELECT conv_id, i, p, q, 3 + 3 * CAST(fault = 't' AS INTEGER), 'R'
            FROM judged, steps WHERE steps.role != 's' AND fault NOT IN ('b', 'd')
        ),
        ways AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS i, q, {{'c': CAST(cost AS BIGINT), 'a': audit}} AS best
            FROM counted, inserted WHERE p = 0
            UNION ALL
            SELECT w.conv_id, w.i + 1, n.q,
                   min({{'c': w.best.c + e.cost + n.cost, 'a': w.best.a || e.audit || n.audit}})
            FROM ways w
            JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i + 1 AND e.p = w.q
            JOIN inserted n ON n.p = e.q
            GROUP BY w.conv_id, w.i, n.q
        ),
        chosen AS (
            SELECT c.conv_id, min(w.best) AS best FROM ways w
            JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i
            WHERE w.q IN (0, 3) GROUP BY c.conv_id
        ),
        -- Every edit with its place, and the number of its row and of its result.
        listed AS (
            SELECT conv_id, place, edit, n_out,
                   count(*) FILTER (edit != 'I') OVER (PARTITION BY conv_id ORDER BY place) AS i,
                   count(*) FILTER (edit != 'D') OVER (PARTITION BY conv_id ORDER BY place) AS o
            FROM (SELECT conv_id, place, substr(best.a, place, 1) AS edit, length(replace(best.a, 'D', '')) AS n_out
                  FROM chosen, unnest(range(1, length(best.a) + 1)) t(place))
        ),
        said AS (
            SELECT l.conv_id, string_agg(
                CASE WHEN edit = 'K' THEN j.role WHEN (o + n_out) % 2 = 1 THEN 'user' ELSE 'assistant' END
                || ':' || CASE WHEN edit = 'I' THEN '' ELSE j.text END, chr(10) ORDER BY place) AS said
            FROM listed l LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.i = l.i
            WHERE edit != 'D' GROUP BY l.conv_id
        ),
        convs AS (SELECT DISTINCT conv_id FROM conversations)
        SELECT v.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               coalesce(h.best.c, 0) AS cost, coalesce(h.best.a, '') AS audit,
               sha256(coalesce(s.said, '')) AS repaired_sha256
        FROM convs v
        LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM v.conv_id
        LEFT JOIN chosen h ON h.conv_id IS NOT DISTINCT FROM v.conv_id
        LEFT JOIN said s ON s.conv_id IS NOT DISTINCT FROM v.conv_id
    """,
    "op13_centroids": f"""
        WITH vectors AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = 64
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k, v FROM vectors
            ORDER BY sha256('1:' || vec_id), v LIMIT 16
        ),
        {_rounds_sql(3)},
        owned AS (SELECT best.k AS k, sum(best.d) AS cluster_inertia FROM a3 GROUP BY ALL)
        SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
               CAST(cluster_inertia AS BIGINT) AS cluster_inertia,
               CAST((SELECT sum(best.d) FROM a3) AS BIGINT) AS inertia,
               sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM vectors JOIN a3 USING (r) JOIN owned o ON o.k = best.k JOIN c3 c ON c.k = best.k
    """,
    "op3_anchors": f"""
        WITH docs AS MATERIALIZED (SELECT doc_id, {_SPACED} AS w FROM documents),
        windows AS (
            SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS said
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20)
        ),
        later AS (
            SELECT doc_id, i FROM windows
            QUALIFY row_number() OVER (PARTITION BY said ORDER BY doc_id, i) > 1
        ),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS said
            FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs)
            ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(said, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)
    """,
    # Bytes as pairs of hex digits; runs of windows that touch are one span.
    "op10_suffixes": """
        WITH docs AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        windows AS (
            SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS said
            FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399)) AS i
                  FROM docs WHERE length(h) >= 800)
        ),
        found AS (
            SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY said) > 1
        ),
        marked AS (
            SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 400, true) AS new
            FROM found
        ),
        spans AS (
            SELECT doc_id, min(i) AS a, max(i) + 400 AS b
            FROM (SELECT *, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked)
            GROUP BY doc_id, k
        ),
        per_doc AS (
            SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last
            FROM spans GROUP BY doc_id
        ),
        gaps AS (
            SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
            UNION ALL
            SELECT doc_id, coalesce(last, 0), length(h) // 2 FROM docs LEFT JOIN per_doc USING (doc_id)
        ),
        kept AS (
            SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS said
            FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes,
               CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(said)) AS kept_sha256
        FROM docs JOIN kept USING (doc_id) LEFT JOIN per_doc USING (doc_id)
    """,
    "op8_decontaminate": f"""
        WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n,
                   array_to_string(w[i:i + 9], ' ') AS said
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
                  FROM items WHERE len(w) > 0)
        ),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
        found AS (
            SELECT d.doc_id, d.i, s.n, s.item_id
            FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS said
                  FROM starts, (SELECT DISTINCT n FROM windows) WHERE i + n - 1 <= len(w)) d
            JOIN windows s ON s.said = d.said AND s.n = d.n
        ),
        hit AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
        ),
        named AS (
            SELECT doc_id, count(*) AS n_items,
                   sha256(string_agg(item_id, ',' ORDER BY item_id COLLATE "C")) AS items_sha256
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found)
            GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
}
