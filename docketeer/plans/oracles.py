"""The queries in DuckDB SQL, written from the rules rather than from the Spark plans.

Pairing runs as the plain loop over the names, the roster and the fuzzy match compare
every pair, ranks come from one window, and hashes are computed in full.
"""

from __future__ import annotations

from docketeer.plans import files
from docketeer.plans import queries as Q


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


BLANKS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
PUNCTUATION = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"
TITLES = _list(["The", "La", "Der"])
STOP = _list(Q.STOP_WORDS)


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{BLANKS}', ' ', 'g'))"


def toks(x: str) -> str:
    return f"list_filter(string_split({squeeze(x)}, ' '), lambda z: z <> '')"


def clean(x: str) -> str:
    bad = (
        f"list_filter(string_split({x}, ' '), lambda p: contains(p, '(') OR contains(p, ')')"
        " OR (contains(p, '.') AND regexp_matches(p, '[0-9]')))"
    )
    cut = f"list_reduce({bad}, lambda a, w: replace(a, w, ''), {x})"
    return squeeze(f"replace({cut}, ' - ', '-')")


def split_at(xs: str, mark: str) -> str:
    def part(i: int) -> str:
        return squeeze(f"string_split(s, '{mark}')[{i}]")

    return (
        f"flatten(list_transform({xs}, lambda s: CASE WHEN contains(s, '{mark}')"
        f" THEN [{part(1)}, {part(2)}] ELSE [s] END))"
    )


def without(x: str, words: str) -> str:
    return f"array_to_string(list_filter({toks(x)}, lambda t: NOT list_contains({words}, t)), ' ')"


def without_each(xs: str, words: str) -> str:
    return f"list_filter(list_transform({xs}, lambda m: {without('m', words)}), lambda m: m <> '')"


def order(x: str) -> str:
    t = toks(x)
    return (
        f"CASE WHEN len({t}) > 1 THEN CASE WHEN contains({t}[1], '-')"
        f" THEN {t}[2] || ' ' || {t}[1] ELSE {t}[1] || ' ' || {t}[2] END ELSE {x} END"
    )


def pair(xs: str) -> str:
    t = toks("n[1]")
    three = f"[{t}[1] || ' ' || {t}[2] || '-' || {t}[3]]"
    couples = (
        f"list_transform(range(len({t}) // 2), lambda i: {t}[2 * i + 1] || ' ' || {t}[2 * i + 2])"
    )
    step = (
        f"CASE WHEN len({t}) = 3 THEN list_concat(a, {three})"
        f" WHEN len({t}) > 2 AND len({t}) % 2 = 0 THEN list_concat(a, {couples}) ELSE names END"
    )
    # A list of one binds the names for the loop over them.
    return (
        f"list_transform([{xs}], lambda names: list_reduce(list_transform(names, lambda n: [n]),"
        f" lambda a, n: list_transform({step}, lambda v: {order('v')}), []::VARCHAR[]))[1]"
    )


def bare(x: str) -> str:
    return f"translate({x}, '{PUNCTUATION}', '')"


def strip(x: str) -> str:
    n = f"(length({x}) - length(replace({x}, '-', '')))"
    return (
        f"CASE WHEN {n} = 0 THEN {bare(x)} WHEN {n} = 1 THEN ''"
        f" ELSE {bare(f'split_part({x}, chr(45), 1)')} || '-' || {bare(f'split_part({x}, chr(45), 2)')} END"
    )


def legal(xs: str, titles: str = TITLES) -> str:
    cleaned = f"list_transform({xs}, lambda c: {clean('c')})"
    split = split_at(split_at(cleaned, ";"), ",")
    words = without_each(without_each(split, titles), STOP)
    return f"list_transform({pair(words)}, lambda p: {strip('p')})"


LISTS = "SELECT doc_id, string_split(text, chr(10)) AS names FROM documents"


def rows(names: str, lists: str = LISTS) -> str:
    return (
        "SELECT doc_id, CAST(unnest(range(len(names))) AS INTEGER) AS pos, unnest(names) AS name"
        f" FROM (SELECT doc_id, {names} AS names FROM ({lists}))"
    )


LINES = rows("names")


def over_lines(expression: str) -> str:
    return f"SELECT doc_id, pos, {expression} AS name FROM ({LINES})"


ROLE_LISTS = ", ".join(
    f"CASE WHEN role = '{r}' THEN string_split(text, chr(10)) END AS \"{r}\"" for r in Q.TURN_ROLES
)
TURNS = (
    "SELECT conv_id || ':' || turn AS id, conv_id, turn, role, string_split(text, chr(10)) AS names,"
    f" {ROLE_LISTS} FROM conversations"
)
TURN_ROWS = (
    "SELECT id, conv_id, turn, role, CAST(unnest(range(len(names))) AS INTEGER) AS pos,"
    f" unnest(names) AS name FROM ({TURNS})"
)
LABELS = (
    "SELECT doc_id, lang || CASE WHEN n_chars > 300 THEN ' - ' || source ELSE '' END"
    " || CASE WHEN n_chars > 1000 THEN ' - long' ELSE '' END AS label FROM documents"
)
FULL_NAMES = (
    "SELECT p_partkey, CASE p_size % 3"
    " WHEN 0 THEN p_brand || '-' || p_type || ' ' || split_part(p_name, ' ', 1)"
    " WHEN 1 THEN p_brand || ' ' || p_name ELSE p_name END AS full_name FROM part"
)


def first_and_last(wrap) -> str:
    t = toks("full_name")
    swapped = f"contains({t}[1], '-')"
    halves = [
        f"CASE WHEN len({t}) = 2 THEN CASE WHEN {swapped} THEN {t}[{3 - i}] ELSE {t}[{i}] END END"
        for i in (1, 2)
    ]
    inner = f"SELECT p_partkey, full_name, {halves[0]} AS f, {halves[1]} AS l FROM ({FULL_NAMES})"
    return (
        f"SELECT p_partkey, full_name, {wrap('f')} AS first_name, {wrap('l')} AS last_name"
        f" FROM ({inner})"
    )


def ranked_names(column: str) -> str:
    return f"""SELECT *, row_number() OVER (ORDER BY {column} COLLATE "C" NULLS LAST, p_partkey) AS rank
      FROM ({first_and_last(lambda x: x)})"""


# Texts

WORD = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]"
NOT_WORD = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]"


def without_prefixed(x: str, words: list[str]) -> str:
    pattern = f"(?:{'|'.join(Q.PREFIXES)})(?:{'|'.join(words)})"
    pieces = f"regexp_extract_all({x}, '{WORD}+|{NOT_WORD}+')"
    kept = f"list_filter({pieces}, lambda p: NOT regexp_full_match(p, '{pattern}'))"
    return squeeze(f"array_to_string({kept}, '')")


def patterns(x: str) -> str:
    for p in Q.PATTERNS:
        x = f"regexp_replace({x}, '{p}', '', 'g')"
    return x


def letter_words(x: str) -> str:
    letters = f"regexp_replace({x}, '[^A-Za-z]', ' ', 'g')"
    return f"list_filter({toks(letters)}, lambda w: length(w) > 1)"


def any_keyword(x: str) -> str:
    return "(" + " OR ".join(f"contains({x}, '{k}')" for k in Q.KEYWORDS) + ")"


# Roster

ROSTER = (
    "SELECT line, min(p_partkey) AS pos FROM (SELECT p_partkey, CASE p_size % 5"
    " WHEN 0 THEN p_name || '-' || lower(p_type) WHEN 1 THEN p_name || ' ' || lower(p_type)"
    " ELSE p_name END AS line FROM part) GROUP BY line"
)
_LAST = "split_part(p_name, ' ', 2)"
JUDGES = (
    f"SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN {_LAST}"
    f" WHEN 1 THEN split_part(p_name, ' ', 1) || chr(39) || ' ' || {_LAST}"
    f" WHEN 2 THEN lower(p_type) || ' ' || {_LAST}"
    f" ELSE split_part(p_name, ' ', 1) || ' ' || left({_LAST}, (p_partkey % 5)::INT)"
    f" || substr({_LAST}, (p_partkey % 5)::INT + 2) END AS name FROM part"
)
# levenshtein counts bytes here, so letters outside ASCII become unused control characters.
ACCENTED = "éèêçàäöüßñóíáÉÈÊÇÀÄÖÜÑÓÍÁ"
UNUSED = [*range(1, 9), *range(14, 32)][: len(ACCENTED)]


def plain(x: str) -> str:
    return f"translate({x}, '{ACCENTED}', {' || '.join(f'chr({i})' for i in UNUSED)})"


def fits(initial: str, surname: str) -> str:
    def near(a: str) -> str:
        return f"levenshtein({plain(a)}, {plain(surname)}) <= 1"

    h = "string_split(r.t[2], '-')"
    return (
        f"r.t[1][1] = {initial} AND ({near('r.t[2]')}"
        f" OR (len(r.t) = 2 AND len({h}) = 2 AND ({near(h + '[1]')} OR {near(h + '[2]')}))"
        f" OR (len(r.t) = 3 AND {near('r.t[3]')}))"
    )


def matched(names: str, keys: str, lines: str = ROSTER) -> str:
    """``names`` has the keys and name; adds matched, null for one token."""
    t = toks("translate(name, '’' || chr(39), '')")
    return f"""
      WITH names AS ({names}),
      tokened AS (SELECT {keys}, name, {t} AS t FROM names),
      probes AS (SELECT DISTINCT t[1][1] AS i, t[2] AS s FROM tokened WHERE len(t) >= 2),
      lines AS (SELECT * FROM (SELECT line, pos, {toks('line')} AS t FROM ({lines})) WHERE len(t) IN (2, 3)),
      best AS (SELECT p.i, p.s, min_by(r.line, r.pos) AS line FROM probes p JOIN lines r
               ON {fits('p.i', 'p.s')} GROUP BY p.i, p.s)
      SELECT {keys}, name, CASE WHEN len(t) >= 2 THEN coalesce(line, name) END AS matched
      FROM tokened LEFT JOIN best ON t[1][1] = i AND t[2] = s"""


JUDGE_LISTS = (
    "SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN []::VARCHAR[]"
    f" ELSE [name, 'x ' || name, 'y'] END AS names FROM ({JUDGES})"
)
ROSTER_LISTS = f"""
  WITH lists AS ({JUDGE_LISTS}),
  found AS ({matched("SELECT p_partkey, unnest(range(len(names))) AS pos, unnest(names) AS name FROM lists", "p_partkey, pos")}),
  kept AS (SELECT p_partkey, list(matched ORDER BY pos) AS fixed FROM found
           WHERE matched IS NOT NULL GROUP BY p_partkey)
  SELECT p_partkey,
         CASE WHEN len(names) > 0 THEN CAST(coalesce(len(fixed), 0) AS INTEGER) END AS n,
         CASE WHEN len(names) > 0 THEN coalesce(array_to_string(fixed, '|'), '') END AS fixed
  FROM lists LEFT JOIN kept USING (p_partkey)"""

ROSTER_SURNAME = f"""
  WITH tokened AS (SELECT p_partkey, name, {toks('name')} AS t FROM ({JUDGES})),
  first AS (SELECT t[1][1] AS i, t[2] AS s, min_by(line, pos) AS line
            FROM (SELECT line, pos, {toks('line')} AS t FROM ({ROSTER})) WHERE len(t) >= 2 GROUP BY 1, 2)
  SELECT p_partkey, name, coalesce(line, name) AS matched
  FROM tokened LEFT JOIN first ON len(t) = 2 AND t[1][1] = i AND t[2] = s"""

PREPARED = (
    f"SELECT p_partkey AS pos, CASE WHEN len(t) = 3 THEN t[3] || ' ' || t[1] || '-' || t[2]"
    f" ELSE {squeeze('full_name')} END AS line"
    f" FROM (SELECT *, {toks('full_name')} AS t FROM ({FULL_NAMES})) WHERE len(t) IN (2, 3)"
)


def corpus_words(table: str) -> str:
    return (
        f"SELECT word, count(*) AS n FROM (SELECT unnest({letter_words('text')}) AS word FROM {table})"
        " GROUP BY word"
    )


def halves(words: str) -> str:
    """Two words within one edit share the first or the last half of the shorter one."""
    sizes = "[length(word) // 2, greatest(length(word) - 1, 0) // 2]"
    return f"""SELECT DISTINCT word, side, h, CASE side WHEN 'first' THEN left(word, h) ELSE right(word, h) END
      AS half FROM (SELECT word, unnest({sizes}) AS h FROM {words}), (SELECT unnest(['first', 'last']) AS side)"""


# Two words are one edit apart if the rest behind their common prefix is the same once a letter is
# left out of the longer one, or of both. The prefix is found by doubled steps, each one comparison.
FUZZY = f"""
  WITH words AS MATERIALIZED ({corpus_words('documents')}),
  items AS MATERIALIZED ({corpus_words('benchmark')}),
  pairs AS MATERIALIZED (
    SELECT DISTINCT w.word AS a, i.word AS b FROM ({halves('words')}) w JOIN ({halves('items')}) i
    USING (side, h, half) WHERE abs(length(w.word) - length(i.word)) <= 1),
  met AS (SELECT a, b, list_reduce(range(20, -1, -1), lambda p, k:
            CASE WHEN p + (1 << k) <= least(length(a), length(b)) AND left(a, p + (1 << k)) = left(b, p + (1 << k))
                 THEN p + (1 << k) ELSE p END, 0) AS p FROM pairs),
  near AS (SELECT DISTINCT a AS word FROM met WHERE
    substr(a, p + 1 + CAST(length(a) >= length(b) AS INTEGER)) = substr(b, p + 1 + CAST(length(b) >= length(a) AS INTEGER)))
  SELECT w.word, w.n, n.word IS NOT NULL AS is_member FROM words w LEFT JOIN near n USING (word)"""

# Dictionary

DICTIONARY = (
    f"SELECT DISTINCT name AS before, {order('name')} AS after FROM ({TURN_ROWS}) WHERE role = 'user'"
)
UPSERT = f"""
  WITH dictionary AS ({DICTIONARY}),
  lists AS (SELECT conv_id, turn, names, {legal('names')} AS afters FROM ({TURNS})),
  pairs AS (SELECT conv_id, turn, unnest(range(len(names))) AS pos, unnest(names) AS before,
                   unnest(afters) AS after FROM lists WHERE len(names) = len(afters)),
  first AS (SELECT before, after FROM pairs
            QUALIFY row_number() OVER (PARTITION BY before ORDER BY conv_id, turn, pos) = 1)
  SELECT before, after FROM dictionary
  UNION ALL
  SELECT before, after FROM first WHERE before NOT IN (SELECT before FROM dictionary)"""


def lookup_sql() -> str:
    outs = ", ".join(
        f"CASE WHEN role = '{r}' THEN found END AS {r}_normalized" for r in Q.TURN_ROLES
    )
    return f"""
      WITH dictionary AS ({DICTIONARY}),
      found AS (SELECT id, role, string_agg(coalesce(after, '<none>'), '|' ORDER BY pos) AS found
                FROM ({TURN_ROWS}) LEFT JOIN dictionary ON name = before GROUP BY id, role)
      SELECT id, {outs} FROM found"""


ASSIGN = """
  WITH listed AS (SELECT DISTINCT o_orderkey || '' AS num, (o_orderkey % 100) || '' AS yy, category
    FROM (SELECT o_orderkey, unnest([o_orderpriority,
          CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END]) AS category FROM orders)
    WHERE category <> ''),
  ids AS (SELECT l_orderkey || '-' || (l_orderkey % 100) || '-' || l_linenumber AS id,
          l_orderkey || '' AS num, (l_orderkey % 100) || '' AS yy FROM lineitem)
  SELECT id, category FROM ids JOIN listed USING (num, yy)"""

# Counts

NAME_COUNTS = f"SELECT name, count(*) AS n FROM ({LINES}) WHERE name <> '' GROUP BY name"
DATED = (
    "SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN"
    " strftime(o_orderdate, '%-d/%-m/%Y') END AS date_text FROM orders"
)


def consumed(column: str) -> str:
    """Hits per item of one name column: a fold over the names in order, per text."""
    return f"""
      (WITH named AS (SELECT list(struct_pack(i := item_id, s := {column}) ORDER BY item_id) AS ns
                      FROM named0),
       folded AS (SELECT list_reduce(
           list_transform(ns, lambda n: struct_pack(t := n.s, h := [n.i], stop := false)),
           lambda a, n: CASE WHEN a.stop THEN a
             WHEN contains(a.t, n.t) THEN struct_pack(
               t := replace(a.t, n.t, ''), h := list_concat(a.h, n.h),
               stop := {squeeze("replace(a.t, n.t, '')")} = '')
             ELSE struct_pack(t := a.t, h := a.h, stop := {squeeze('a.t')} = '') END,
           struct_pack(t := array_to_string(string_split(text, chr(10)), ' '),
                       h := []::BIGINT[], stop := false)) AS f
         FROM documents, named)
       SELECT i, count(*) AS n FROM (SELECT unnest(f.h) AS i FROM folded) GROUP BY i)"""


def name_count_sql() -> str:
    t = toks("text")
    columns = ("full_name", "first_name", "last_name")
    counts = ", ".join(f"coalesce({c[:2]}.n, 0) AS count_{c}" for c in columns)
    joins = " ".join(
        f"LEFT JOIN {consumed(c)} {c[:2]} ON {c[:2]}.i = item_id" for c in columns
    )
    return f"""
      WITH named0 AS (SELECT item_id, array_to_string({t}, ' ') AS full_name, {t}[1] AS first_name,
                      {t}[-1] AS last_name FROM benchmark)
      SELECT item_id, full_name, first_name, last_name, {counts} FROM named0 {joins}"""


SUBCATEGORIES = f"""
  WITH parts AS (SELECT string_split(label, ' - ') AS p FROM ({LABELS})),
  subs AS (SELECT p[1] AS category, CASE WHEN len(p) = 3 THEN p[2] || ' - ' || p[3] ELSE p[2] END
           AS sub_category FROM parts)
  SELECT category, sub_category, count(*) AS n FROM subs GROUP BY ALL
  UNION ALL SELECT category, category || ' Total', count(*) FROM subs GROUP BY category"""


def summary_sql() -> str:
    each = [
        f"""SELECT '{c}' AS "column", sum(n)::BIGINT AS "count", count(*) AS "unique",
            (list(v ORDER BY n DESC, v))[1] AS top, max(n) AS freq
            FROM (SELECT {c}::VARCHAR AS v, count(*) AS n FROM part WHERE {c} IS NOT NULL GROUP BY 1)"""
        for c in ("p_name", "p_brand", "p_type", "p_size")
    ]
    return " UNION ALL ".join(each)


PARTS = f"SELECT unnest(string_split(name, ',')) AS name FROM ({LINES})"
STEPS = f"""
  SELECT 'lines' AS step, count(*) AS n FROM ({LINES})
  UNION ALL SELECT 'split', count(*) FROM ({PARTS})
  UNION ALL SELECT 'unrepeated', count(*) FROM
    (SELECT name FROM ({PARTS}) GROUP BY name HAVING count(*) = 1)"""

# Sampling

HASH = f"md5(doc_id || '|{Q.SEED}')"
SPLIT = f"""
  SELECT doc_id, lang, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY {HASH}, doc_id)
    <= ceil(count(*) OVER (PARTITION BY lang) * {Q.SHARE}::DOUBLE) THEN 'test' ELSE 'train' END AS part
  FROM documents"""
NULL_SPLIT = SPLIT.replace("FROM documents", "FROM (SELECT * REPLACE (CASE WHEN n_chars > 300 THEN lang END AS lang) FROM documents)")
BALANCED = f"""
  SELECT model, label, part, doc_id FROM (
    SELECT *, least(min(test) OVER m, test) AS take_test, min(total - test) OVER m AS take_train,
      CASE WHEN r <= min(test) OVER m THEN 'test'
           WHEN r > test AND r <= test + min(total - test) OVER m THEN 'train' END AS part
    FROM (
      SELECT *, CAST(ceil(total * {Q.SHARE}::DOUBLE) AS BIGINT) AS test FROM (
        SELECT model, CAST(lang = model AS INTEGER) AS label, doc_id,
          row_number() OVER (PARTITION BY model, lang = model ORDER BY {HASH}, doc_id) AS r,
          count(*) OVER (PARTITION BY model, lang = model) AS total
        FROM documents, (SELECT unnest({_list(Q.LANGS)}) AS model)))
    WINDOW m AS (PARTITION BY model))
  WHERE part IS NOT NULL"""

# Terms and models

TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"


def grams(n: str) -> str:
    return (
        f"list_transform(range(greatest(len(w) - {n} + 1, 0)),"
        f" lambda i: array_to_string(w[i + 1 : i + {n}], ' '))"
    )


TF = f"""SELECT doc_id, term, count(*) AS tf FROM
  (SELECT doc_id, unnest({TOKENS}) AS term FROM documents) GROUP BY ALL"""
TFIDF = f"""
  WITH tf AS ({TF}), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
  x AS (SELECT doc_id, term, tf, df,
        tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS x FROM tf JOIN df USING (term))
  SELECT doc_id, term, tf, df, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS weight
  FROM x"""
RANKED = f"""
  WITH tf AS ({TF}),
  w AS (SELECT doc_id, term, tf, tf / sqrt(sum(tf * tf) OVER (PARTITION BY doc_id)) AS weight FROM tf)
  SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, round(weight, 6) AS weight FROM
    (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tf DESC, term) AS rank FROM w)
  WHERE rank BETWEEN 31 AND 60"""


def model_sql(cells: str) -> str:
    """CTEs of the models of all (model, n) ``cells``, from split to likelihoods."""
    return f"""
      split AS ({BALANCED}),
      members AS (SELECT s.model, n, label, part, doc_id FROM split s JOIN ({cells}) c ON s.model = c.model),
      train AS (SELECT * FROM members WHERE part = 'train'),
      sizes AS (SELECT model, n, count(*) AS n_docs, sum(label)::BIGINT AS n1 FROM train GROUP BY ALL),
      words AS MATERIALIZED (SELECT doc_id, {TOKENS} AS w FROM documents),
      grams AS MATERIALIZED (SELECT doc_id, n, term, count(*) AS tf FROM
        (SELECT doc_id, n, unnest({grams('n')}) AS term
         FROM words, (SELECT DISTINCT n FROM ({cells})) d) GROUP BY ALL),
      tf AS (SELECT t.model, t.n, t.label, doc_id, term, tf FROM train t JOIN grams g USING (doc_id, n)),
      df AS (SELECT model, n, term, count(*) AS df FROM tf GROUP BY ALL),
      idf AS (SELECT d.model, d.n, term, df, ln((1 + n_docs) / (1 + df)) + 1 AS idf
              FROM df d JOIN sizes s ON d.model = s.model AND d.n = s.n),
      x AS (SELECT tf.model, tf.n, label, doc_id, term, tf * idf AS x FROM tf JOIN idf USING (model, n, term)),
      w AS (SELECT model, n, label, term, x / sqrt(sum(x * x) OVER (PARTITION BY model, n, doc_id, label)) AS w
            FROM x),
      f AS (SELECT model, n, term, coalesce(sum(w) FILTER (label = 0), 0) AS f0,
            coalesce(sum(w) FILTER (label = 1), 0) AS f1 FROM w GROUP BY ALL),
      totals AS (SELECT model, n, sum(f0) AS t0, sum(f1) AS t1, count(*) AS n_terms FROM f GROUP BY ALL),
      terms AS (SELECT f.model, f.n, f.term, df, idf, ln((f0 + 1) / (t0 + n_terms)) AS log_p0,
                ln((f1 + 1) / (t1 + n_terms)) AS log_p1
                FROM f JOIN totals USING (model, n) JOIN idf USING (model, n, term)),
      classes AS (SELECT s.model, s.n, n_docs, coalesce(n_terms, 0) AS n_terms,
                  ln((n_docs - n1) / n_docs) AS log_prior0, ln(n1 / n_docs) AS log_prior1
                  FROM sizes s LEFT JOIN totals t ON s.model = t.model AND s.n = t.n)"""


CHOSEN = " UNION ALL ".join(f"SELECT '{m}' AS model, {n} AS n" for m, n in Q.SIZES.items())
SEARCHED = (
    f"SELECT unnest({_list(Q.LANGS)}) AS model, n FROM (SELECT unnest({Q.SEARCH}) AS n)"
)
LEAD = """SELECT g.doc_id, t.model, t.n, sum(tf * idf * (log_p1 - log_p0)) AS lead,
          sqrt(sum(tf * idf * tf * idf)) AS norm FROM grams g JOIN terms t USING (n, term) GROUP BY ALL"""
# Every text under every model: where a text has no term of a model the priors decide alone.
SCORES = f"""
  SELECT d.doc_id, c.model, c.n,
         1 / (1 + exp(-(log_prior1 - log_prior0 + coalesce(lead / norm, 0)))) AS p
  FROM (SELECT doc_id FROM documents) d CROSS JOIN classes c LEFT JOIN ({LEAD}) l
    ON l.doc_id = d.doc_id AND l.model = c.model AND l.n = c.n"""
POSITION = "CASE model " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(Q.SIZES)) + " END"


def report_sql(cells: str) -> str:
    each = """
      SELECT model, n, c AS class, sum((label = c AND predicted = c)::INT) AS tp,
             sum((label = c)::INT) AS support, sum((predicted = c)::INT) AS said
      FROM predicted, (SELECT unnest([0, 1]) AS c) GROUP BY ALL
      HAVING sum((label = c)::INT) + sum((predicted = c)::INT) > 0"""
    return f"""
      WITH {model_sql(cells)},
      scores AS ({SCORES}),
      predicted AS (SELECT m.model, m.n, m.doc_id, label, CAST(coalesce(p, 0.5) > 0.5 AS INTEGER) AS predicted
        FROM members m LEFT JOIN scores s ON m.model = s.model AND m.n = s.n AND m.doc_id = s.doc_id
        WHERE part = 'test'),
      each AS ({each}),
      rates AS (SELECT model, n, class, CASE WHEN said = 0 THEN 0 ELSE tp / said END AS precision,
        CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
        2 * tp / (said + support) AS f1, support, tp FROM each)
      SELECT model, n, class::VARCHAR AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
             round(f1, 6) AS f1, support::BIGINT AS support FROM rates
      UNION ALL SELECT model, n, 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), sum(support)::BIGINT
        FROM rates GROUP BY model, n
      UNION ALL SELECT model, n, 'macro avg', round(avg(precision), 6), round(avg(recall), 6),
        round(avg(f1), 6), sum(support)::BIGINT FROM rates GROUP BY model, n
      UNION ALL SELECT model, n, 'weighted avg', round(sum(precision * support) / sum(support), 6),
        round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
        sum(support)::BIGINT FROM rates GROUP BY model, n"""


# Co-occurrence

TOP_WORDS = f"""
      words AS (SELECT doc_id, lang, list_distinct({TOKENS}) AS words FROM documents),
      top AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) AS rank FROM
        (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM words) GROUP BY word)
        QUALIFY rank <= {Q.TOP}),
      held AS (SELECT doc_id, lang, words FROM words
               WHERE list_has_any(words, (SELECT list(word) FROM top)))"""
INDICATORS = (
    f"WITH {TOP_WORDS} SELECT doc_id, "
    + ", ".join(
        f"list_contains(words, (SELECT word FROM top WHERE rank = {i})) AS top_{i:02}"
        for i in range(1, Q.TOP + 1)
    )
    + ", "
    + ", ".join(f"lang = '{c}' AS is_{c}" for c in Q.LANGS)
    + " FROM held"
)
# A row of a column that holds one of its top names has every feature of the column, there or not.
PAIR_SUMS = f"""
      kinds AS (SELECT col, 'name' AS kind, word AS f, rank AS place FROM top
        UNION ALL SELECT DISTINCT col, 'category', unnest({_list(Q.LANGS)}), 100 + unnest(range({len(Q.LANGS)})) FROM top),
      cells AS (SELECT h.doc_id, k.*, CAST(CASE kind WHEN 'name' THEN list_contains(words, f) ELSE lang = f END AS INTEGER) AS v
                FROM held h JOIN kinds k USING (col)),
      sums AS (SELECT a.col, a.kind AS kind_a, a.f AS feature_a, b.kind AS kind_b, b.f AS feature_b,
               count(*)::DOUBLE AS n, sum(a.v)::DOUBLE AS n1, sum(b.v)::DOUBLE AS n2, sum(a.v * b.v)::DOUBLE AS n11
               FROM cells a JOIN cells b ON a.doc_id = b.doc_id AND a.col = b.col AND a.place < b.place GROUP BY ALL),
      corr AS (SELECT col, kind_a, feature_a, kind_b, feature_b,
               CASE WHEN n1 * (n - n1) > 0 AND n2 * (n - n2) > 0 THEN
               (n * n11 - n1 * n2) / (sqrt(n1 * (n - n1)) * sqrt(n2 * (n - n2))) END AS corr FROM sums)"""
CORR = f"""
      all_words AS (SELECT doc_id, lang, list_distinct({TOKENS}) AS words FROM documents),
      top AS (SELECT 'words' AS col, word, row_number() OVER (ORDER BY n DESC, word) AS rank FROM
        (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM all_words) GROUP BY word)
        QUALIFY rank <= {Q.TOP}),
      held AS (SELECT doc_id, lang, words, 'words' AS col FROM all_words
               WHERE list_has_any(words, (SELECT list(word) FROM top))),
      {PAIR_SUMS}"""
ROLE_CORR = f"""
      words AS (SELECT doc_id, lang, col, list_filter(words, lambda w: length(w) % {len(Q.NAME_COLUMNS)} = i) AS words
        FROM (SELECT doc_id, lang, list_distinct({TOKENS}) AS words FROM documents),
             (SELECT unnest({_list(Q.NAME_COLUMNS)}) AS col, unnest(range({len(Q.NAME_COLUMNS)})) AS i)),
      top AS (SELECT col, word, row_number() OVER (PARTITION BY col ORDER BY n DESC, word) AS rank FROM
        (SELECT col, word, count(*) AS n FROM (SELECT col, unnest(words) AS word FROM words) GROUP BY ALL)
        QUALIFY rank <= {Q.TOP}),
      lists AS (SELECT col, list(word) AS listed FROM top GROUP BY col),
      held AS (SELECT doc_id, lang, words, col FROM words JOIN lists USING (col) WHERE list_has_any(words, listed)),
      {PAIR_SUMS}"""


def top_pairs() -> str:
    ties = "kind_a, feature_a, kind_b, feature_b"

    def side(sign: str, direction: str) -> str:
        return f"""SELECT '{sign}' AS sign, CAST(row_number() OVER (ORDER BY corr {direction}, {ties}) AS INTEGER)
          AS rank, {ties}, round(corr, 6) AS corr FROM corr
          WHERE corr IS NOT NULL QUALIFY rank <= {Q.PAIRS}"""

    return f"WITH {CORR} {side('positive', 'DESC')} UNION ALL {side('negative', 'ASC')}"


# Whole jobs


def normalized_sql(failed: str = "lang = 'es'", more: str = "") -> str:
    titles = _list(["The", "La"])
    flat = f"""SELECT doc_id, lang, names FROM ({LISTS})
      JOIN documents USING (doc_id)"""
    judges = f"""SELECT id, unnest(range(len(js))) AS pos, unnest(js) AS name FROM cleaned
      WHERE NOT ({failed})"""

    def party(xs: str) -> str:
        return f"array_to_string(list_transform({xs}, lambda c: {clean('c')}), '|')"

    return f"""
      WITH flat AS ({flat}),
      cleaned AS (SELECT doc_id::VARCHAR AS id, lang, {party('names')} AS petitioner,
        {party('list_reverse(names)')} AS defense, {legal('names', titles)} AS js,
        {legal('list_reverse(names)', titles)} AS ps FROM flat),
      found AS ({matched(judges, "id, pos")}),
      kept AS (SELECT id, string_agg(matched, '|' ORDER BY pos) AS judges FROM found
               WHERE matched IS NOT NULL GROUP BY id)
      SELECT id, {more} CASE WHEN {failed} THEN 'missing judges' END AS error_reason,
        CASE WHEN NOT ({failed}) AND len(js) > 0 THEN coalesce(judges, '') END AS judges,
        CASE WHEN NOT ({failed}) THEN petitioner END AS petitioner,
        CASE WHEN NOT ({failed}) THEN defense END AS defense,
        CASE WHEN NOT ({failed}) THEN array_to_string(ps, '|') END AS petitioner_attorneys,
        CASE WHEN NOT ({failed}) THEN array_to_string(js, '|') END AS defense_attorneys
      FROM cleaned LEFT JOIN kept USING (id)"""


def clean_legal(xs: str) -> str:
    """Judges and attorneys with nothing lost: all parts, every name by itself, hyphens kept."""

    def parts(ys: str, mark: str) -> str:
        return (
            f"flatten(list_transform({ys}, lambda s:"
            f" list_transform(string_split(s, '{mark}'), lambda p: {squeeze('p')})))"
        )

    t = toks("m")
    split = parts(parts(f"list_transform({xs}, lambda c: {clean('c')})", ";"), ",")
    words = without_each(without_each(split, TITLES), STOP)
    paired = f"""flatten(list_transform({words}, lambda m: CASE
      WHEN len({t}) = 3 THEN [{t}[1] || ' ' || {t}[2] || '-' || {t}[3]]
      WHEN len({t}) > 2 AND len({t}) % 2 = 0 THEN list_transform(range(len({t}) // 2),
        lambda i: {t}[2 * i + 1] || ' ' || {t}[2 * i + 2])
      ELSE [array_to_string({t}, ' ')] END))"""
    ordered = f"""list_transform({paired}, lambda o: CASE
      WHEN len(string_split(o, ' ')) = 2 AND contains(string_split(o, ' ')[1], '-')
        AND NOT contains(string_split(o, ' ')[2], '-')
      THEN string_split(o, ' ')[2] || ' ' || string_split(o, ' ')[1] ELSE o END)"""
    marks = PUNCTUATION.replace("-", "")
    bare = f"list_transform({ordered}, lambda b: {squeeze(f"translate(b, '{marks}', '')")})"
    return f"list_filter({bare}, lambda e: e <> '')"


LONG_WORDS = (
    "list_filter(list_transform(list_transform({xs}, lambda m: array_to_string(list_filter("
    + toks("m")
    + f", lambda t: length(t) < {Q.LONG_WORD} AND t NOT IN ('The', 'La')), ' ')), lambda m: m), lambda m: m <> '')"
)


def word_table_sql() -> str:
    cut = split_at(split_at(f"list_transform(names, lambda c: {clean('c')})", ";"), ",")
    paired = pair(LONG_WORDS.replace("{xs}", cut))
    lists = f"SELECT doc_id::VARCHAR AS id, list_transform({paired}, lambda p: {strip('p')}) AS js FROM ({LISTS})"
    each = "SELECT id, unnest(range(len(js))) AS pos, unnest(js) AS name FROM cleaned"
    return f"""
      WITH cleaned AS ({lists}), found AS ({matched(each, "id, pos")}),
      kept AS (SELECT id, string_agg(matched, '|' ORDER BY pos) AS judges FROM found
               WHERE matched IS NOT NULL GROUP BY id)
      SELECT id, CASE WHEN len(js) > 0 THEN coalesce(judges, '') END AS judges,
             array_to_string(js, '|') AS defense_attorneys FROM cleaned LEFT JOIN kept USING (id)"""


ENRICHED = f"""
  WITH {model_sql(CHOSEN)},
  best AS (SELECT doc_id, max(struct_pack(p := p, i := {POSITION}, model := model)) AS b
           FROM ({SCORES}) GROUP BY doc_id),
  normalized AS ({normalized_sql()})
  SELECT id, error_reason, judges, defense,
         CASE WHEN error_reason IS NULL THEN CASE WHEN b.p > 0.5 THEN b.model ELSE 'Inconclusive' END END
           AS category
  FROM normalized JOIN best ON id = doc_id::VARCHAR"""

def dictionary_sql(good: str) -> str:
    return f"""
  WITH js AS (SELECT doc_id::VARCHAR AS id, names, {legal('names', _list(["The", "La"]))} AS js
              FROM ({LISTS}) JOIN documents USING (doc_id) WHERE {good}),
  each AS (SELECT id, unnest(range(len(js))) AS pos, unnest(js) AS name FROM js),
  found AS ({matched("SELECT * FROM each", "id, pos")}),
  kept AS (SELECT id, list(matched ORDER BY pos) AS fixed FROM found WHERE matched IS NOT NULL GROUP BY id),
  pairs AS (SELECT id, unnest(range(len(names))) AS pos, unnest(names) AS before, unnest(fixed) AS after
            FROM js JOIN kept USING (id) WHERE len(names) = len(fixed))
  SELECT before, after FROM pairs
  QUALIFY row_number() OVER (PARTITION BY before ORDER BY id COLLATE "C", pos) = 1"""


ORACLES: dict[str, str] = {
    "clean_names": rows(f"list_transform(names, lambda c: {clean('c')})"),
    "split_names": rows(split_at(split_at("names", ";"), ",")),
    "remove_stop_tokens": rows(without_each("names", STOP)),
    "remove_stop_tokens_single": over_lines(without("name", STOP)),
    "remove_listed_tokens": f"""
      WITH words AS (SELECT list(DISTINCT t) AS ws FROM (SELECT unnest({toks('text')}) AS t FROM benchmark))
      SELECT doc_id, pos, array_to_string(list_filter({toks('name')},
        lambda t: NOT list_contains(ws, t)), ' ') AS name FROM ({LINES}), words""",
    "pair_names": rows(pair("names")),
    "order_names": over_lines(order("name")),
    "strip_names": over_lines(strip("name")),
    "strip_apostrophes": over_lines("translate(name, '’' || chr(39), '')"),
    "first_and_last_names": first_and_last(strip),
    "names_sorted_by_last": ranked_names("last_name"),
    "names_sorted_by_first": ranked_names("first_name"),
    "legal_names": rows(legal("names")),
    "organize_name_rows": f"""
      SELECT doc_id, pos, CAST(unnest(range(len(vs))) AS INTEGER) AS pair, unnest(vs) AS name FROM (
        SELECT doc_id, pos, CASE
          WHEN len(t) = 3 THEN [CASE WHEN contains(t[1], '-') THEN t[2] || '-' || t[3] || ' ' || t[1]
                                ELSE t[1] || ' ' || t[2] || '-' || t[3] END]
          WHEN len(t) > 2 AND len(t) % 2 = 0 THEN list_transform(range(len(t) // 2),
            lambda i: CASE WHEN contains(t[1], '-') THEN t[2 * i + 2] || ' ' || t[2 * i + 1]
                      ELSE t[2 * i + 1] || ' ' || t[2 * i + 2] END)
          ELSE [name] END AS vs
        FROM (SELECT *, {toks('name')} AS t FROM ({LINES})))""",
    "explode_delimited": f"""
      SELECT doc_id, pos, unnest(CASE WHEN contains(name, ',')
        THEN list_concat([name], string_split(name, ',')) ELSE [name] END) AS name FROM ({LINES})""",
    "split_by_token_count": f"""
      SELECT doc_id, pos, name, CASE WHEN len(string_split(name, ' ')) > 3 THEN 'many' ELSE 'few' END
        AS part FROM ({LINES})""",
    "split_by_role": f"""
      SELECT id, role, pos, name, CASE WHEN role IN ('user', 'system') THEN 'party' ELSE 'legal' END
        AS part FROM ({TURN_ROWS})""",
    "replace_patterns": f"SELECT doc_id, {patterns('text')} AS text FROM documents",
    "remove_prefixed_words": (
        f"SELECT doc_id, {without_prefixed('text', Q.STOP_WORDS)} AS text FROM documents"
    ),
    "clean_text": f"""SELECT doc_id, {without_prefixed('t', Q.NAMES)} AS text FROM
      (SELECT doc_id, {without_prefixed('b', Q.STOP_WORDS)} AS t FROM
        (SELECT doc_id, translate(text, '{PUNCTUATION}0123456789', '') AS b FROM documents))""",
    "bare_tokens": f"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n, array_to_string(t, ' ') AS words
      FROM (SELECT doc_id, {toks(bare('text'))} AS t FROM documents)""",
    "word_counts": f"""SELECT doc_id, word, count(*) AS n FROM
      (SELECT doc_id, unnest({letter_words('text')}) AS word FROM documents) GROUP BY ALL""",
    "keyword_matches": f"SELECT doc_id, source FROM documents WHERE {any_keyword('text')}",
    "keyword_match_count": f"SELECT count(*) AS n FROM documents WHERE {any_keyword('text')}",
    "roster_match": matched(JUDGES, "p_partkey"),
    "roster_match_lists": ROSTER_LISTS,
    "roster_surname": ROSTER_SURNAME,
    "prepare_roster": PREPARED,
    "fuzzy_members": FUZZY,
    "dictionary_upsert": UPSERT,
    "dictionary_lookup": lookup_sql(),
    "category_assign": ASSIGN,
    "distinct_names_by_role": f"SELECT DISTINCT role, name FROM ({TURN_ROWS})",
    "names_per_role": f"SELECT role, count(DISTINCT name) AS n FROM ({TURN_ROWS}) GROUP BY role",
    "name_counts": NAME_COUNTS,
    "top_names": f"{NAME_COUNTS} ORDER BY n DESC, name LIMIT {Q.TOP}",
    "top_legal_names": f"""SELECT name, count(*) AS n FROM ({rows(legal('names'))}) WHERE name <> ''
      GROUP BY name ORDER BY n DESC, name LIMIT {Q.TOP}""",
    "normalized_name_counts": name_count_sql(),
    "category_counts": f"""SELECT split_part(label, ' - ', 1) AS category, count(*) AS n
      FROM ({LABELS}) GROUP BY 1""",
    "sorted_category_counts": """SELECT source AS category, count(*) AS n FROM documents
      GROUP BY source ORDER BY n DESC, category""",
    "category_shares": """SELECT lang AS category, count(*) AS n,
      round(count(*) / (SELECT count(*) FROM documents), 6) AS share FROM documents GROUP BY lang""",
    "subcategory_counts": SUBCATEGORIES,
    "date_span": f"""SELECT min(d) AS earliest, max(d) AS latest, count(d) AS dated FROM
      (SELECT try_strptime(date_text, '%d/%m/%Y')::DATE AS d FROM ({DATED}))""",
    "undated_ids": f"SELECT o_orderkey FROM ({DATED}) WHERE date_text IS NULL",
    "column_summary": summary_sql(),
    "step_counts": STEPS,
    "unrepeated_values": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
      QUALIFY count(*) OVER (PARTITION BY l_partkey, l_suppkey) = 1""",
    "unrepeated_rows": "SELECT role, text FROM conversations GROUP BY ALL HAVING count(*) = 1",
    "train_test_split": SPLIT,
    "split_with_nulls": NULL_SPLIT,
    "one_vs_rest_split": BALANCED,
    "random_rows": f"SELECT doc_id, lang, source FROM documents ORDER BY {HASH}, doc_id LIMIT 10",
    "first_rows": "SELECT doc_id, lang, source FROM documents ORDER BY lang, doc_id LIMIT 100",
    "tfidf": TFIDF,
    "term_rank_window": RANKED,
    "model_terms": f"""WITH {model_sql(CHOSEN)} SELECT model, n, term, df,
      round(idf, 6) AS idf, round(log_p0, 6) AS log_p0, round(log_p1, 6) AS log_p1 FROM terms""",
    "model_classes": f"""WITH {model_sql(CHOSEN)} SELECT model, n, n_docs, n_terms,
      round(log_prior0, 6) AS log_prior0, round(log_prior1, 6) AS log_prior1 FROM classes""",
    "model_scores": f"""WITH {model_sql(CHOSEN)}
      SELECT doc_id, model, n, round(p, 6) AS p FROM ({SCORES})""",
    "choose_category": f"""WITH {model_sql(CHOSEN)},
      best AS (SELECT doc_id, max(struct_pack(p := p, i := {POSITION}, model := model)) AS b
               FROM ({SCORES}) GROUP BY doc_id)
      SELECT doc_id, CASE WHEN coalesce(b.p, 0.5) > 0.5 THEN b.model ELSE 'Inconclusive' END AS category,
             round(coalesce(b.p, 0.5), 6) AS p FROM documents LEFT JOIN best USING (doc_id)""",
    "classification_report": report_sql(CHOSEN),
    "ngram_search": report_sql(SEARCHED),
    "indicator_table": INDICATORS,
    "correlations": f"""WITH {CORR}
      SELECT kind_a, feature_a, kind_b, feature_b, round(corr, 6) AS corr FROM corr""",
    "role_correlations": f"""WITH {ROLE_CORR}
      SELECT col AS "column", kind_a, feature_a, kind_b, feature_b, round(corr, 6) AS corr FROM corr""",
    "top_correlated_pairs": top_pairs(),
    "normalize_documents": normalized_sql(),
    "normalize_with_word_table": word_table_sql(),
    "legal_names_clean": rows(clean_legal("names")),
    "enrich_documents": ENRICHED,
    "enrich_dictionary": dictionary_sql("lang <> 'es'"),
    "stream_enrich": ENRICHED,
    "route_failures": """SELECT CASE WHEN lang = 'es' THEN 'failed' ELSE 'success' END AS status,
      count(*) AS n FROM documents GROUP BY 1""",
    "stream_normalize": normalized_sql(),
    "stream_dictionary": f"""SELECT before, after FROM (SELECT name AS before, role AS after,
        row_number() OVER (PARTITION BY name ORDER BY conv_id % 3, conv_id, turn, pos) AS r FROM ({TURN_ROWS}))
      WHERE r = 1""",
    # Verdicts without judges come out in the second attempt, with their petitioners for judges.
    "stream_replay": normalized_sql("FALSE", "CASE WHEN lang = 'es' THEN 1 ELSE 0 END AS attempt,"),
    "stream_judge_dictionary": dictionary_sql("TRUE"),
} | files.ORACLES
