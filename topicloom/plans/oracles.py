"""The same queries as DuckDB SQL, written independently of the Spark plans."""

from __future__ import annotations

import zipfile
from pathlib import Path

import pyspark
from pyspark import SparkContext

from ..operators.ladder import default_levels
from ..operators.labels import LABEL_PROMPT, MERGE_PROMPT, SUMMARY_PROMPT
from ..operators.tfidf import EXTRA_STOP_WORDS, stop_words
from . import queries as Q

SPACE = r"[\s\p{Z}\x{85}\x{0b}\x{1c}-\x{1f}]"
NOT_SPACE = r"[^\s\p{Z}\x{85}\x{0b}\x{1c}-\x{1f}]"
NOT_WORD = r"[^\p{L}\p{N}_]"


def dropped_words() -> list[str]:
    """The words the Spark side drops, also when no session has started yet: then
    Spark's list is read from where Spark keeps it."""
    if SparkContext._active_spark_context is not None:
        return stop_words()
    jar = next((Path(pyspark.__file__).parent / "jars").glob("spark-mllib_*.jar"))
    with zipfile.ZipFile(jar) as archive:
        listed = archive.read("org/apache/spark/ml/feature/stopwords/english.txt").decode()
    return sorted(set(listed.split()) | set(EXTRA_STOP_WORDS))


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(expr: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(replacement)}, 'g')"


def strip(expr: str) -> str:
    return sub(expr, f"^{SPACE}+|{SPACE}+$", "")


def tokens(expr: str) -> str:
    return rf"regexp_extract_all(lower({expr}), '[\p{{L}}\p{{N}}_]+')"


def clean(expr: str, entities: bool = True) -> str:
    e = sub(f"coalesce({expr}, '')", "<[^>]+>", " ")
    if entities:
        for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("nbsp", "\u00a0"),
                           ("copy", "©"), ("middot", "·"), ("amp", "&")):
            e = f"replace({e}, '&{name};', {lit(char)})"
    for pattern, replacement in ((r'\\"([a-zA-Z])', r"\1"), (r"\\'", ""), (r"\$(.*?)\$", r"\1"),
                                 (r"\\[a-zA-Z]+\{(.*?)\}", r"\1"),
                                 (r"\\(begin|end)\{.*?\}", " "), (r"\\[a-zA-Z]+", "")):
        e = sub(e, pattern, replacement)
    e = f"replace(replace({e}, '``', '\"'), '''''', '\"')"
    return f"trim({sub(e, SPACE + '+', ' ')})"


def long_form(source: str, ids: str, vec: str, more: str = "") -> str:
    more = f", {more}" if more else ""
    return f"""
SELECT {ids}{more}, (pos - 1)::BIGINT AS pos, round(x::DOUBLE, 6) AS value
FROM (SELECT {ids}{more}, unnest({vec}) AS x, unnest(range(1, len({vec}) + 1)) AS pos
      FROM {source})"""


TITLED = """titled AS (
  SELECT d.doc_id, d.lang, d.source, 'quality ' || l.quality::VARCHAR AS title, d.text AS abstract
  FROM documents d LEFT JOIN labels l USING (doc_id)
  UNION ALL
  SELECT -1 - doc_id, NULL, NULL,
         CASE WHEN quality = 0 THEN ' \u3000\u00a0' ELSE 'quality ' || quality::VARCHAR END, NULL
  FROM labels)"""

CLUSTERED = r"""clustered AS (
  SELECT doc_id, CASE WHEN no = 0 THEN -1 ELSE no END AS cluster_id, text
  FROM (SELECT doc_id, text, regexp_extract(source, '(\d+)$', 1)::BIGINT AS no FROM documents))"""


def noisy(limit: float = 0.1) -> str:
    return f"""SELECT vec_id, embedding::DOUBLE[] AS embedding,
      (CASE WHEN embedding[1]::DOUBLE > {limit} THEN -1 ELSE label END)::BIGINT AS cluster_id
      FROM embeddings"""


HASHED = f"""
tok AS (SELECT doc_id, unnest({tokens('text')}) AS w FROM documents),
coded AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 8))::BIGINT % 64 AS b,
                 CASE WHEN ('0x' || substr(md5(w), 9, 8))::BIGINT % 2 = 1 THEN 1 ELSE -1 END AS s
          FROM tok),
bucket AS (SELECT doc_id, b, sum(s)::DOUBLE AS v FROM coded GROUP BY doc_id, b),
entry AS (SELECT doc_id, lang, source, unnest(range(64)) AS b FROM documents),
raw AS (SELECT e.doc_id, any_value(lang) AS lang, any_value(source) AS source,
               list(coalesce(v, 0) ORDER BY e.b) AS r
        FROM entry e LEFT JOIN bucket k ON e.doc_id = k.doc_id AND e.b = k.b GROUP BY e.doc_id),
hashed AS MATERIALIZED (
  SELECT doc_id, lang, source, CASE WHEN n > 0 THEN list_transform(r, lambda x: x / n) ELSE r END AS vec
  FROM (SELECT *, sqrt(list_dot_product(r, r)) AS n FROM raw))"""

UNIT = """
hashed AS MATERIALIZED (SELECT vec_id AS doc_id,
  list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS vec
  FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings))"""

# Distinct vectors. Those of one group of copies are equal to the last bit here.
REPS = """
reps AS MATERIALIZED (SELECT vec, min(doc_id) AS id, count(*) AS copies FROM hashed
                      WHERE list_dot_product(vec, vec) > 0 GROUP BY vec)"""


def components(node_table: str, edge_table: str) -> str:
    """comp(node, component) over edges (i, j), isolated nodes included."""
    return f"""
both_ways AS (SELECT i, j FROM {edge_table} UNION SELECT j, i FROM {edge_table}),
reach AS (SELECT node, node AS root FROM {node_table}
          UNION SELECT b.j, r.root FROM reach r JOIN both_ways b ON b.i = r.node),
comp AS MATERIALIZED (SELECT node, min(root) AS component FROM reach GROUP BY node)"""


def tfidf(source: str) -> str:
    """top_terms(g, rank, term, score) over source(g, d, t)."""
    words = ", ".join(lit(w) for w in dropped_words())
    return rf"""
texts AS (SELECT g, d, t FROM {source} WHERE regexp_matches(t, '{NOT_SPACE}')),
words AS (SELECT g, d, unnest({tokens('t')}) AS w FROM texts),
tf AS (SELECT g, d, w, count(*) AS tf FROM words WHERE w NOT IN ({words}) GROUP BY g, d, w),
voc AS (SELECT g, w, df FROM (
          SELECT g, w, count(*) AS df,
                 row_number() OVER (PARTITION BY g ORDER BY sum(tf) DESC, w) AS r
          FROM tf GROUP BY g, w) WHERE r <= 5000),
sizes AS (SELECT g, count(*) AS n FROM texts GROUP BY g),
x AS (SELECT tf.g, tf.d, tf.w, tf.tf * (ln((1e0 + n) / (1e0 + df)) + 1) AS x
      FROM tf JOIN voc ON tf.g = voc.g AND tf.w = voc.w JOIN sizes ON tf.g = sizes.g),
norms AS (SELECT g, d, sqrt(sum(x * x)) AS norm FROM x GROUP BY g, d),
scores AS (SELECT x.g, x.w, round(sum(x / norm), 6) AS score
           FROM x JOIN norms ON x.g = norms.g AND x.d = norms.d GROUP BY x.g, x.w),
top_terms AS MATERIALIZED (SELECT * FROM (
    SELECT g, row_number() OVER (PARTITION BY g ORDER BY score DESC, w) AS rank,
           w AS term, score FROM scores) WHERE rank <= 10)"""


def info() -> str:
    return f"""{CLUSTERED},
src AS (SELECT cluster_id AS g, doc_id AS d, text AS t FROM clustered
        WHERE cluster_id <> -1 AND text IS NOT NULL),
{tfidf('src')},
listed AS (SELECT g, list(term ORDER BY rank) AS terms FROM top_terms GROUP BY g),
info AS MATERIALIZED (
  SELECT s.g AS cluster_id, array_to_string(coalesce(terms, ['placeholdertext']), ', ') AS keywords,
         array_to_string(coalesce(terms, ['placeholdertext'])[1:3], ' / ') AS name,
         '' AS summary, s.size
  FROM (SELECT g, count(*) AS size FROM src GROUP BY g) s LEFT JOIN listed USING (g))"""


def formatted(template: str, *exprs: str) -> str:
    pieces = template.split("%s")
    out = [lit(pieces[0])]
    for expr, piece in zip(exprs, pieces[1:]):
        out += [expr, lit(piece)]
    return "(" + " || ".join(out) + ")"


def prompts() -> str:
    return f"""{info()},
firsts AS (SELECT cluster_id, string_agg(text, chr(10) ORDER BY doc_id) AS texts FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY doc_id) AS r FROM clustered
    WHERE cluster_id <> -1 AND text IS NOT NULL) WHERE r <= 5 GROUP BY cluster_id),
prompts AS (SELECT i.cluster_id, i.size, {formatted(LABEL_PROMPT, 'i.keywords')} AS label_prompt,
    {formatted(SUMMARY_PROMPT, "coalesce(f.texts, '')")} AS summary_prompt
  FROM info i LEFT JOIN firsts f USING (cluster_id))"""

ENVELOPE = f"""
  SELECT d.doc_id, d.lang, d.source,
         coalesce('quality ' || l.quality::VARCHAR,
                  CASE WHEN d.lang <> 'de' THEN d.source || ' ' || d.doc_id::VARCHAR END) AS title,
         {strip("replace(replace(d.text, chr(13) || chr(10), chr(10)), chr(13), chr(10))")} AS abstract
  FROM documents d LEFT JOIN labels l USING (doc_id)"""

DOC_TYPE = (r"CASE WHEN regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])"
            r"(email|key|token|license|copyright)([^\p{L}\p{N}_]|$)') "
            r"THEN 'contact' ELSE 'scientific_paper' END")

KNN = """
scored AS (SELECT a.doc_id AS i, b.doc_id AS j, list_dot_product(a.vec, b.vec) AS cosine
           FROM {h} a JOIN {h} b ON a.doc_id <> b.doc_id),
ranked AS (SELECT i, j, cosine, row_number() OVER (
             PARTITION BY i ORDER BY round(cosine, 10) DESC, j) AS rank FROM scored)
SELECT i, j, rank, round(cosine, 6) AS cosine FROM ranked WHERE rank <= 5"""

TOPIC_NODES = f"""{HASHED},
node_no AS (SELECT lang, source, row_number() OVER (ORDER BY lang, source) - 1 AS node
            FROM (SELECT DISTINCT lang, source FROM documents)),
node_entry AS (SELECT node, lang || ' ' || source AS name, pos, avg(x) AS x FROM (
    SELECT lang, source, unnest(vec) AS x, unnest(range(64)) AS pos FROM hashed)
  JOIN node_no USING (lang, source) GROUP BY ALL),
nodes AS MATERIALIZED (SELECT node, name, list(x ORDER BY pos) AS vec FROM node_entry
                       GROUP BY node, name)"""

MERGED_WORDS = """
word AS (SELECT g, unnest(string_split(name, ' ')) AS w FROM members),
word_n AS (SELECT g, w, count(*) AS n FROM word WHERE w NOT IN ('', '/') GROUP BY g, w),
word_top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, w) AS r
                            FROM word_n) WHERE r <= 3),
named AS (SELECT m.g, coalesce(any_value(t.name), 'General') AS name
  FROM (SELECT DISTINCT g FROM members) m LEFT JOIN
       (SELECT g, string_agg(w, ' / ' ORDER BY r) AS name FROM word_top GROUP BY g) t USING (g)
  GROUP BY m.g)"""

CORES = """
dist AS MATERIALIZED (SELECT a.doc_id AS i, b.doc_id AS j, list_distance(a.vec, b.vec) AS d
         FROM hashed a JOIN hashed b ON a.doc_id <> b.doc_id),
cores AS MATERIALIZED (SELECT i AS node, d AS core FROM (
    SELECT i, d, row_number() OVER (PARTITION BY i ORDER BY d) AS r FROM dist) WHERE r = 4)"""

def keyed_components(name: str, nodes: str, edges: str, key: str = "") -> str:
    """name([key,] node, root): smallest node reachable, by keyed recursion."""
    k = f"{key}, " if key else ""
    same = f" AND {{0}}.{key} = l.{key}" if key else ""
    b_key = f"b.{key} AS {key}, " if key else ""
    group = f"b.{key}, b.j" if key else "b.j"
    return f"""
{name}_b AS MATERIALIZED (SELECT {k}i, j FROM {edges} UNION SELECT {k}j, i FROM {edges}),
{name}({k}node, root) USING KEY ({k}node) AS (
  SELECT {k}node, node AS root FROM {nodes}
  UNION
  SELECT {b_key}b.j AS node, min(l.root) AS root
  FROM {name} l JOIN {name}_b b ON b.i = l.node{same.format("b")}
       JOIN recurring.{name} m ON m.node = b.j{same.format("m")}
  WHERE l.root < m.root GROUP BY {group})"""


def density_leaves(radii: list[float]) -> str:
    radii = sorted(radii, reverse=True)
    values = ", ".join(f"({r}::DOUBLE)" for r in radii)
    steps, state = [f"s0 AS (SELECT node, root AS leaf FROM kept WHERE r = {radii[0]}::DOUBLE)"], "s0"
    for n, r in enumerate(radii[1:], 1):
        steps.append(f"""k{n} AS (SELECT node, root FROM kept WHERE r = {r}::DOUBLE),
p{n} AS (SELECT leaf, count(DISTINCT root) AS parts FROM {state} JOIN k{n} USING (node) GROUP BY leaf),
s{n} AS MATERIALIZED (SELECT node, leaf FROM (
  SELECT s.node, CASE WHEN coalesce(parts, 0) >= 2 THEN k.root ELSE s.leaf END AS leaf
  FROM {state} s LEFT JOIN k{n} k ON k.node = s.node LEFT JOIN p{n} p ON p.leaf = s.leaf)
  WHERE leaf IS NOT NULL)""")
        state = f"s{n}"
    joined = ",\n".join(steps)
    return f"""
WITH RECURSIVE {HASHED}, {CORES},
radii(r) AS (VALUES {values}),
dense AS MATERIALIZED (SELECT r, node FROM radii JOIN cores ON core <= r),
links AS MATERIALIZED (SELECT a.r, i, j FROM dist JOIN dense a ON a.node = i AND d <= a.r
  JOIN dense b ON b.node = j AND b.r = a.r WHERE i < j),
{keyed_components("lab", "dense", "links", "r")},
big AS (SELECT r, root FROM lab GROUP BY r, root HAVING count(*) >= 10),
kept AS MATERIALIZED (SELECT lab.r, node, lab.root FROM lab JOIN big ON lab.r = big.r AND lab.root = big.root),
{joined},
number AS (SELECT leaf, row_number() OVER (ORDER BY leaf) - 1 AS cluster_id
           FROM (SELECT DISTINCT leaf FROM {state}))
SELECT h.doc_id, coalesce(n.cluster_id, -1)::BIGINT AS cluster_id
FROM hashed h LEFT JOIN {state} s ON s.node = h.doc_id LEFT JOIN number n ON n.leaf = s.leaf"""


def density_tree(radii: list[float], size: int = 10) -> str:
    """Clusters at each radius, found anew for each."""
    values = ", ".join(f"({r}::DOUBLE)" for r in radii)
    return f"""
WITH RECURSIVE {HASHED}, {CORES},
radii(r) AS (VALUES {values}),
dense AS MATERIALIZED (SELECT r, node FROM radii JOIN cores ON core <= r),
links AS MATERIALIZED (SELECT a.r, i, j FROM dist JOIN dense a ON a.node = i AND d <= a.r
  JOIN dense b ON b.node = j AND b.r = a.r WHERE i < j),
{keyed_components("lab", "dense", "links", "r")},
big AS (SELECT r, root, row_number() OVER (PARTITION BY r ORDER BY root) - 1 AS cluster_id
        FROM lab GROUP BY r, root HAVING count(*) >= {size}),
found AS (SELECT lab.r, node, cluster_id FROM lab JOIN big ON lab.r = big.r AND lab.root = big.root)
SELECT radii.r AS radius, h.doc_id, coalesce(cluster_id, -1)::BIGINT AS cluster_id
FROM hashed h CROSS JOIN radii LEFT JOIN found f ON f.node = h.doc_id AND f.r = radii.r"""


def density_tree_leaves(largest: float, floor: float, size: int = 10, samples: int = 5) -> str:
    """Merges one by one, the lightest edge between two groups first; then every group of
    every distinct distance, and the distances at which groups come apart."""
    return f"""
WITH RECURSIVE {HASHED}, {CORES.replace("r = 4", f"r = {samples - 1}")},
dense AS MATERIALIZED (SELECT node, row_number() OVER (ORDER BY node) AS k FROM cores WHERE core <= {largest}),
edges AS MATERIALIZED (SELECT a.k AS x, b.k AS y, round(greatest(d, ca.core, cb.core), 10) AS w
  FROM dist JOIN dense a ON a.node = i JOIN dense b ON b.node = j
  JOIN cores ca ON ca.node = i JOIN cores cb ON cb.node = j
  WHERE i < j AND greatest(d, ca.core, cb.core) <= {largest}),
kruskal(step, w, lab) AS (
  SELECT 0, -1::DOUBLE, list(k::INT ORDER BY k) FROM dense
  UNION ALL
  SELECT step + 1, e.w, list_transform(lab, lambda l: CASE WHEN l = greatest(lab[e.x], lab[e.y])
                                       THEN least(lab[e.x], lab[e.y]) ELSE l END)
  FROM (SELECT step, lab, arg_min(struct_pack(x := x, y := y, w := d.w), struct_pack(w := d.w, x := x, y := y)) AS e
        FROM kruskal, edges d WHERE lab[x] <> lab[y] GROUP BY step, lab)),
states AS (SELECT lab, w, row_number() OVER (ORDER BY w) AS t FROM (
  SELECT w, arg_max(lab, step) AS lab FROM kruskal GROUP BY w)),
place AS MATERIALIZED (SELECT t, w, unnest(range(1, len(lab) + 1)) AS k, unnest(lab) AS root FROM states),
sizes AS MATERIALIZED (SELECT t, root, count(*) >= {size} AS big FROM place GROUP BY t, root),
parts AS (SELECT a.t, a.root, count(DISTINCT b.root) FILTER (s.big) AS n
  FROM place a JOIN place b ON b.k = a.k AND b.t = a.t - 1 JOIN sizes s ON s.t = b.t AND s.root = b.root
  GROUP BY a.t, a.root),
split AS (SELECT DISTINCT t, root FROM parts JOIN states USING (t) WHERE n >= 2 AND w >= {floor}),
first AS (SELECT p.k, min(s.t) AS t FROM place p JOIN split s ON s.t = p.t AND s.root = p.root GROUP BY p.k),
head AS MATERIALIZED (SELECT p.k, p.t, p.root, coalesce(f.t, 1000000) AS below FROM place p LEFT JOIN first f USING (k)
  WHERE p.t = coalesce(f.t - 1, (SELECT max(t) FROM states))),
members AS (SELECT h.t, h.root, p.k, coalesce(f.t, 1000000) AS below
  FROM (SELECT DISTINCT t, root FROM head JOIN sizes USING (t, root) WHERE big) h
  JOIN place p ON p.t = h.t AND p.root = h.root LEFT JOIN first f ON f.k = p.k),
leaves AS (SELECT t, root, min(k) AS low FROM members GROUP BY t, root HAVING min(below) > t),
named AS (SELECT t, root, row_number() OVER (ORDER BY low) - 1 AS cluster_id FROM leaves),
found AS (SELECT d.node, cluster_id FROM head JOIN named USING (t, root) JOIN dense d USING (k))
SELECT h.doc_id, coalesce(cluster_id, -1)::BIGINT AS cluster_id
FROM hashed h LEFT JOIN found ON found.node = h.doc_id"""


def chain(epsilons: dict[str, float], size: int = 10) -> str:
    """found(config, doc_id, file, component, n) over the papers that the pipelines make of the
    documents: numbered, cleaned, embedded, clustered at each radius."""
    opening = f"(?i)^({'|'.join(Q.X.BOILERPLATE_WORDS)})({NOT_WORD}|$)"
    values = ", ".join(f"('{k}', {e}::DOUBLE)" for k, e in epsilons.items())
    return f"""
WITH RECURSIVE numbered AS (SELECT row_number() OVER (ORDER BY doc_id::VARCHAR) - 1 AS doc_id,
  doc_id::VARCHAR AS file, source AS title, {clean('text')} AS c FROM main.documents),
documents AS (SELECT doc_id, file, title || ' ' || c AS text, '' AS lang, '' AS source FROM numbered
  WHERE NOT regexp_matches(c, {lit(opening)})),
{HASHED}, {CORES},
radii(config, r) AS (VALUES {values}),
dense AS MATERIALIZED (SELECT config, r, node FROM radii JOIN cores ON core <= r),
links AS MATERIALIZED (SELECT a.config, i, j FROM dist JOIN dense a ON a.node = i AND d <= a.r
  JOIN dense b ON b.node = j AND b.config = a.config WHERE i < j),
{keyed_components("lab", "dense", "links", "config")},
big AS (SELECT config, root, row_number() OVER (PARTITION BY config ORDER BY root) - 1 AS cluster_id
        FROM lab GROUP BY config, root HAVING count(*) >= {size}),
found AS MATERIALIZED (SELECT radii.config, d.doc_id, d.file, coalesce(cluster_id, -1)::BIGINT AS cluster_id
  FROM documents d CROSS JOIN radii LEFT JOIN lab ON lab.node = d.doc_id AND lab.config = radii.config
  LEFT JOIN big ON big.config = lab.config AND big.root = lab.root)"""


def ladder(levels: list[float], rounds_per_level: int = 4) -> tuple[str, str, str]:
    """The rounds of the ladder one after the other: the common tables, the
    history, and the nodes after each level.

    Loops do not nest in SQL, so every level gets a fixed number of rounds; the
    last one must find nothing, as it does on the given tables.
    """
    steps = ["n0 AS MATERIALIZED (SELECT node, name, 1::BIGINT AS leaves, vec FROM nodes)",
             "c0 AS MATERIALIZED (SELECT 0 AS rn)",
             "stride AS MATERIALIZED (SELECT max(node) + 1 AS s FROM nodes)"]
    history, after = [], []
    k = 0
    for t in levels:
        first = k
        for _ in range(rounds_per_level):
            p, k = k, k + 1
            steps += [f"""e{k} AS MATERIALIZED (SELECT a.node AS i, b.node AS j FROM n{p} a JOIN n{p} b
  ON a.node < b.node AND list_dot_product(a.vec, b.vec)
     / sqrt(list_dot_product(a.vec, a.vec) * list_dot_product(b.vec, b.vec)) >= {t})""",
                      keyed_components(f"l{k}", f"n{p}", f"e{k}"), f"""
g{k} AS MATERIALIZED (SELECT root, min(node % (SELECT s FROM stride))
    + ((SELECT rn FROM c{p}) + 1) * (SELECT s FROM stride) AS parent
  FROM l{k} GROUP BY root HAVING count(*) > 1)""",
                      f"c{k} AS MATERIALIZED (SELECT rn + (SELECT count(*) > 0 FROM g{k})::INT AS rn FROM c{p})",
                      f"""m{k} AS MATERIALIZED (SELECT g.parent AS g, n.* FROM l{k} l
  JOIN g{k} g ON g.root = l.root JOIN n{p} n ON n.node = l.node)""",
                      f"""w{k} AS MATERIALIZED (SELECT g, w, count(*) AS n
  FROM (SELECT g, unnest(string_split(name, ' ')) AS w FROM m{k}) WHERE w NOT IN ('', '/') GROUP BY g, w)""",
                      f"""t{k} AS MATERIALIZED (SELECT g, string_agg(w, ' / ' ORDER BY r) AS name FROM (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, w) AS r FROM w{k}) WHERE r <= 3 GROUP BY g)""",
                      f"""v{k} AS MATERIALIZED (SELECT g, list(x ORDER BY pos) AS vec FROM (
  SELECT g, pos, avg(x) AS x FROM (SELECT g, unnest(vec) AS x, unnest(range(64)) AS pos FROM m{k})
  GROUP BY g, pos) GROUP BY g)""",
                      f"""z{k} AS MATERIALIZED (SELECT g, sum(leaves)::BIGINT AS leaves FROM m{k} GROUP BY g)""",
                      f"""n{k} AS MATERIALIZED (
  SELECT * FROM n{p} WHERE node NOT IN (SELECT node FROM m{k})
  UNION ALL SELECT g, name, leaves, vec FROM t{k} JOIN z{k} USING (g) JOIN v{k} USING (g))"""]
            history.append(f"""SELECT {t}::DOUBLE AS level, (SELECT rn FROM c{k}) AS round,
  m.node AS child_id, m.g AS parent_id, t.name AS new_name FROM m{k} m JOIN t{k} t USING (g)""")
        after.append(f"""SELECT {t}::DOUBLE AS level, * FROM n{k}
  WHERE (SELECT rn FROM c{k}) > (SELECT rn FROM c{first})""")
    return (f"WITH RECURSIVE {TOPIC_NODES},\n" + ",\n".join(steps),
            "\nUNION ALL ".join(history), "\nUNION ALL ".join(after))


FUNNEL = f"""{TITLED},
not_empty AS (SELECT doc_id, coalesce(title, '') AS title, coalesce(abstract, '') AS abstract
  FROM titled WHERE regexp_matches(coalesce(title, ''), '{NOT_SPACE}')
                 OR regexp_matches(coalesce(abstract, ''), '{NOT_SPACE}'))"""

LETTERS = r"' ' || trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g')) || ' '"


def oracles() -> dict[str, str]:
    words = "|".join(Q.OPENING_WORDS)
    opening = f"(?i)^({words})({NOT_WORD}|$)"
    boilerplate = f"(?i)^({'|'.join(Q.X.BOILERPLATE_WORDS)})({NOT_WORD}|$)"
    cuts = ", ".join(f"({t}::DOUBLE)" for t in Q.CUTS)
    marked = " || ".join([
        lit("\\begin{abstract} \\emph{"), "source", lit("} "), "text",
        lit("\n ``na\\\"ive'' $\\alpha_"), "lang",
        lit("$ l\\'eau \\cite \u3000\u00a0\u2028 \\end{abstract}")])
    sql = {}

    # Sources and sinks
    sql["extract_record"] = (f"SELECT doc_id, title, abstract, NULL::VARCHAR AS corrupt "
                             f"FROM ({ENVELOPE})")
    sql["scan_records"] = f"SELECT title, abstract FROM ({ENVELOPE})"
    sql["ingest_incremental"] = f"SELECT title, abstract FROM ({ENVELOPE})"
    sql["ingest_upsert"] = f"""
SELECT doc_id, CASE WHEN lang = 'de' THEN 2 ELSE 1 END AS version,
  {strip("replace(replace(CASE WHEN lang = 'de' THEN 'new ' ELSE '' END || text, chr(13) || chr(10), chr(10)), chr(13), chr(10))")} AS abstract
FROM documents"""
    sql["union_batches"] = """
SELECT 'documents' AS batch, doc_id AS id, text, lang FROM documents
UNION ALL SELECT 'benchmark', item_id, text, NULL FROM benchmark"""
    sql["roundtrip_csv"] = (f"WITH {TITLED} SELECT doc_id::VARCHAR AS file, title, abstract "
                            "FROM titled")
    sql["sample_docs"] = """SELECT doc_id, lang FROM documents
ORDER BY md5('42:' || doc_id::VARCHAR), doc_id LIMIT 100"""
    sql["load_centroids"] = f"""
WITH configs AS (
  SELECT '5_10' AS source_config, label::BIGINT AS cluster_id, embedding FROM embeddings
  UNION ALL
  SELECT '10_20', ((embedding[1] > 0)::INT + 2 * (embedding[2] > 0)::INT
                   + 4 * (embedding[3] > 0)::INT)::BIGINT, embedding FROM embeddings),
entries AS (SELECT source_config, cluster_id, unnest(embedding)::DOUBLE AS x,
                   unnest(range(64)) AS pos FROM configs)
SELECT source_config, cluster_id, 'topic ' || cluster_id AS cluster_name, pos::BIGINT AS pos,
       round(avg(x), 6) AS value
FROM entries GROUP BY source_config, cluster_id, pos"""

    # Text
    sql["drop_empty"] = f"WITH {FUNNEL} SELECT doc_id, title, abstract FROM not_empty"
    sql["clean_text"] = f"SELECT doc_id, {clean(f'({marked})')} AS clean_abstract FROM documents"
    sql["clean_html"] = f"SELECT page_id, {clean('html')} AS clean_html FROM pages"
    sql["classify_docs"] = f"""SELECT doc_id, {DOC_TYPE} AS type,
  'scientific_paper' AS coded_type, 'diagnostic_report' AS shot_type FROM documents"""
    sql["route_by_type"] = f"""SELECT {DOC_TYPE} AS type, count(*) AS docs,
  sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1"""
    sql["drop_boilerplate"] = f"""SELECT doc_id, c AS clean_abstract
FROM (SELECT doc_id, {clean('text')} AS c FROM documents)
WHERE NOT regexp_matches(c, {lit(opening)})"""
    sql["doc_text"] = f"""WITH {TITLED} SELECT doc_id,
  coalesce(title, '') || ' ' || coalesce(abstract, '') AS embedding_text,
  coalesce(title, '') || '. ' || coalesce(abstract, '') AS combined_text FROM titled"""
    sql["funnel_counts"] = f"""WITH {FUNNEL},
papers AS (SELECT {clean('abstract')} AS c FROM (SELECT *, abstract AS text FROM not_empty)
           WHERE {DOC_TYPE} = 'scientific_paper')
SELECT 0::BIGINT AS position, 'loaded' AS stage, count(*) AS n FROM titled
UNION ALL SELECT 1, 'not_empty', count(*) FROM not_empty
UNION ALL SELECT 2, 'papers', count(*) FROM papers
UNION ALL SELECT 3, 'kept', count(*) FROM papers WHERE NOT regexp_matches(c, {lit(boilerplate)})"""
    sql["token_counts"] = f"""
WITH tok AS (SELECT lang, doc_id, unnest({tokens('text')}) AS term FROM documents)
SELECT lang, term, count(*) AS occurrences, count(DISTINCT doc_id) AS documents
FROM tok GROUP BY lang, term"""
    sql["tfidf_terms"] = f"""
WITH src AS (SELECT lang AS g, doc_id AS d, text AS t FROM documents), {tfidf('src')}
SELECT g AS lang, rank, term, score FROM top_terms"""
    sql["language_id"] = f"""
WITH padded AS (SELECT doc_id, lang, {LETTERS} AS p FROM documents),
grams AS (SELECT doc_id, lang, unnest(list_transform(range(1, length(p) - 1),
                 lambda i: substr(p, i, 3))) AS gram FROM padded WHERE length(p) > 2),
tf AS MATERIALIZED (SELECT doc_id, lang, gram, count(*) AS n FROM grams GROUP BY ALL),
prof AS (SELECT lang, gram, sum(n) AS n FROM tf WHERE doc_id % 2 = 0 GROUP BY lang, gram),
base AS (SELECT lang, -ln(sum(n)::DOUBLE + count(*)::DOUBLE) AS base FROM prof GROUP BY lang),
len AS (SELECT doc_id, sum(n)::DOUBLE AS length FROM tf GROUP BY doc_id),
gain AS (SELECT tf.doc_id, prof.lang, sum(tf.n * ln(prof.n::DOUBLE + 1)) AS gain
         FROM tf JOIN prof ON tf.gram = prof.gram WHERE tf.doc_id % 2 = 1
         GROUP BY tf.doc_id, prof.lang),
scored AS (SELECT g.doc_id, g.lang, round(base + gain / length, 6) AS score
           FROM gain g JOIN base b ON g.lang = b.lang JOIN len l ON g.doc_id = l.doc_id),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang)
                        AS r FROM scored) WHERE r = 1)
SELECT d.doc_id, b.lang AS language, b.score FROM documents d LEFT JOIN best b USING (doc_id)
WHERE d.doc_id % 2 = 1"""
    sql["known_language"] = f"""WITH {TITLED}
SELECT doc_id, 'en' AS title_lang, lang AS abstract_lang FROM titled
WHERE title IS NOT NULL AND regexp_matches(coalesce(abstract, ''), '{NOT_SPACE}')"""

    # Vectors
    sql["hash_embed"] = f"WITH {HASHED} {long_form('hashed', 'doc_id', 'vec')}"
    sql["embed_with"] = f"""
WITH f AS (SELECT doc_id, [length(text), length(text) - length(replace(text, ' ', '')),
                           length(text) - length(replace(text, 'e', '')), 1]::DOUBLE[] AS v
           FROM documents),
u AS (SELECT doc_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM f)
{long_form('u', 'doc_id', 'v')}"""
    sql["parse_vector"] = long_form("embeddings", "vec_id", "embedding")
    sql["l2_normalize"] = f"""
WITH scaled AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x, k:
    CASE WHEN k = 1 AND x > 0.2 THEN 0 ELSE x * label END) AS v FROM embeddings),
u AS (SELECT vec_id, CASE WHEN n > 0 THEN list_transform(v, lambda x: x / n) ELSE v END AS v
      FROM (SELECT *, sqrt(list_dot_product(v, v)) AS n FROM scaled))
{long_form('u', 'vec_id', 'v')}"""
    pairs = """
SELECT a.id AS i, b.id AS j, round(list_dot_product(a.vec, b.vec), 6) AS cosine,
       a.copies AS copies_i, b.copies AS copies_j
FROM reps a JOIN reps b ON a.id < b.id AND list_dot_product(a.vec, b.vec) >= {t}"""
    sql["cosine_pairs"] = f"WITH {UNIT}, {REPS} {pairs.format(t=0.4)}"
    sql["cosine_pairs_texts"] = f"WITH {HASHED}, {REPS} {pairs.format(t=0.9)}"
    sql["vector_copies"] = f"""WITH {HASHED}, {REPS}
SELECT h.doc_id, r.id AS first_copy FROM hashed h JOIN reps r ON h.vec = r.vec"""
    sql["knn_graph"] = f"WITH {UNIT}, {KNN.format(h='hashed')}"
    sql["knn_graph_texts"] = (f"WITH {HASHED}, nonzero AS MATERIALIZED (SELECT * FROM hashed "
                              "WHERE list_dot_product(vec, vec) > 0), "
                              f"{KNN.format(h='nonzero')}")

    # Graphs and clusters
    emb_pairs = """pairs AS MATERIALIZED (
  SELECT a.doc_id AS i, b.doc_id AS j, list_dot_product(a.vec, b.vec) AS cosine
  FROM hashed a JOIN hashed b ON a.doc_id < b.doc_id AND list_dot_product(a.vec, b.vec) >= {t})"""
    sql["connected_components"] = f"""
WITH RECURSIVE {UNIT}, {emb_pairs.format(t=0.35)},
linked AS (SELECT i AS node FROM pairs UNION SELECT j FROM pairs), {components('linked', 'pairs')}
SELECT node, component FROM comp"""
    sql["threshold_cuts"] = f"""
WITH RECURSIVE {UNIT}, {emb_pairs.format(t=min(Q.CUTS))},
t AS (SELECT * FROM (VALUES {cuts}) v(threshold)),
edge AS (SELECT threshold, i, j FROM t JOIN pairs ON cosine >= threshold
         UNION SELECT threshold, j, i FROM t JOIN pairs ON cosine >= threshold),
reach AS (SELECT threshold, doc_id AS node, doc_id AS root FROM t, hashed
          UNION SELECT r.threshold, e.j, r.root FROM reach r
                JOIN edge e ON e.threshold = r.threshold AND e.i = r.node)
SELECT threshold, node AS vec_id, min(root) AS component FROM reach GROUP BY threshold, node"""
    sql["threshold_groups_texts"] = f"""
WITH RECURSIVE {HASHED}, {REPS},
links AS (SELECT a.id AS i, b.id AS j FROM reps a JOIN reps b
          ON a.id < b.id AND list_dot_product(a.vec, b.vec) >= 0.9),
ids AS (SELECT id AS node FROM reps), {components('ids', 'links')}
SELECT h.doc_id, coalesce(c.component, h.doc_id) AS component FROM hashed h
LEFT JOIN reps r ON h.vec = r.vec LEFT JOIN comp c ON c.node = r.id"""
    embedded = UNIT.replace("list_transform(e, lambda x: x / sqrt(list_dot_product(e, e)))", "e")
    sql["core_distance"] = (f"WITH {embedded}, {CORES} "
                            "SELECT node AS vec_id, round(core, 6) AS core FROM cores")
    sql["mutual_reachability"] = f"""WITH {embedded}, {CORES}
, near AS MATERIALIZED (SELECT i, j, d FROM dist WHERE i < j AND d <= 1.1)
SELECT i, j, round(greatest(a.core, b.core, d), 6) AS reach
FROM near JOIN cores a ON a.node = i JOIN cores b ON b.node = j"""
    sql["density_clusters"] = f"""
WITH RECURSIVE {HASHED}, {CORES},
dense AS (SELECT node FROM cores WHERE core <= 0.5),
links AS (SELECT i, j FROM dist JOIN dense a ON a.node = i JOIN dense b ON b.node = j
          WHERE d <= 0.5), {components('dense', 'links')},
big AS (SELECT component, row_number() OVER (ORDER BY component) - 1 AS cluster_id
        FROM comp GROUP BY component HAVING count(*) >= 10)
SELECT h.doc_id, coalesce(b.cluster_id, -1)::BIGINT AS cluster_id
FROM hashed h LEFT JOIN comp c ON c.node = h.doc_id LEFT JOIN big b USING (component)"""
    sql["density_leaves"] = density_leaves([0.8, 0.7, 0.6, 0.5, 0.4, 0.3])
    sql["density_tree"] = density_tree(Q.RADII)
    sql["density_tree_leaves"] = density_tree_leaves(0.8, 0.3)
    sql["sweep_leaves"] = " UNION ALL ".join(
        f"SELECT {n} AS config, * FROM ({density_tree_leaves(c['largest'], c['floor'], c['min_cluster_size'], c['min_samples'])})"
        for n, c in enumerate(Q.SWEEP))
    runs = " UNION ALL ".join(f"SELECT {n}::BIGINT AS config, vec_id, cluster_id FROM ({noisy(t)})"
                              for n, t in enumerate([0.0, 0.1, 0.2, 0.2]))
    scores = f"""SELECT config, n_clusters, n_outliers,
  round(n_clusters / (1 + n_outliers / greatest(1, n)), 6) AS score
FROM (SELECT config, count(DISTINCT cluster_id) FILTER (cluster_id <> -1) AS n_clusters,
             count(*) FILTER (cluster_id = -1) AS n_outliers, count(*) AS n
      FROM ({runs}) GROUP BY config)"""
    sql["score_configs"] = scores
    sql["pick_best"] = f"SELECT * FROM ({scores}) ORDER BY score DESC, config LIMIT 1"

    # Labels
    sql["cluster_info"] = f"WITH {info()} SELECT * FROM info"
    sql["label_docs"] = f"""WITH {info()}
SELECT c.doc_id, c.cluster_id, i.name, i.summary FROM clustered c LEFT JOIN info i USING (cluster_id)"""
    # Case 0 has rows without a name and is labelled again, case 1 has none and stays.
    sql["relabel"] = f"""WITH {info()}
SELECT 0 AS run, c.doc_id, c.cluster_id, i.name, i.summary FROM clustered c LEFT JOIN info i USING (cluster_id)
WHERE EXISTS (SELECT 1 FROM clustered WHERE cluster_id <> -1 AND length(text) <= 1000)
UNION ALL SELECT 1, doc_id, cluster_id, 'outdated', 'old' FROM clustered"""
    sql["prompt_table"] = f"WITH {prompts()} SELECT * FROM prompts"
    sql["name_with"] = f"""WITH {prompts()}
SELECT i.cluster_id, i.keywords,
       CASE WHEN i.size >= 50 THEN length(p.label_prompt) || ' characters' ELSE i.name END AS name,
       length(p.summary_prompt) || ' characters' AS summary, i.size
FROM info i JOIN prompts p USING (cluster_id)"""
    said = "'<think>' || text || '</think>' || chr(10) || ' ' || role || ' \u3000'"
    sql["clean_answer"] = f"""SELECT conv_id, turn,
  {strip(f"string_split(replace({said}, '<think>', ''), '</think>')[-1]")} AS answer
FROM conversations"""
    sql["merged_names"] = f"""
WITH members AS (SELECT role AS g, text AS name FROM conversations), {MERGED_WORDS}
SELECT g AS role, name FROM named"""
    sql["merge_prompts"] = f"""
WITH n AS (SELECT DISTINCT lang, lang || ' ' || source AS name FROM documents),
g AS (SELECT lang, list(name ORDER BY name) AS names FROM n GROUP BY lang)
SELECT lang, {formatted(MERGE_PROMPT, "array_to_string(names, ', ')",
    "'Keywords: ' || array_to_string(flatten(list_transform(names, lambda n: string_split(n, ' '))), ', ')")}
  AS prompt FROM g"""
    sql["run_metadata"] = f"""SELECT '{{}}' AS best_config,
  count(DISTINCT cluster_id) FILTER (cluster_id <> -1) AS n_clusters,
  count(*) FILTER (cluster_id = -1) AS n_outliers, false AS use_model FROM ({noisy()})"""

    # Ladder
    sql["centroids"] = f"""
WITH e AS (SELECT cluster_id, unnest(embedding) AS x, unnest(range(64)) AS pos
           FROM ({noisy()}) WHERE cluster_id <> -1)
SELECT cluster_id, count(*) AS size, pos::BIGINT AS pos, round(avg(x), 6) AS value
FROM e GROUP BY cluster_id, pos"""
    sql["merge_round"] = f"""
WITH RECURSIVE {TOPIC_NODES},
links AS (SELECT a.node AS i, b.node AS j FROM nodes a JOIN nodes b ON a.node < b.node
  AND list_dot_product(a.vec, b.vec)
      / sqrt(list_dot_product(a.vec, a.vec) * list_dot_product(b.vec, b.vec)) >= 0.95),
{components('nodes', 'links')},
groups AS (SELECT component, count(*) AS n FROM comp GROUP BY component HAVING count(*) > 1),
members AS MATERIALIZED (
  SELECT c.component + (SELECT max(node) + 1 FROM nodes) AS g, n.node, n.name, n.vec
  FROM comp c JOIN groups USING (component) JOIN nodes n ON n.node = c.node),
{MERGED_WORDS},
sizes AS (SELECT g, count(*) AS leaves FROM members GROUP BY g),
entries AS (SELECT g, unnest(vec) AS x, unnest(range(64)) AS pos FROM members),
merged AS (SELECT g, pos, avg(x) AS x FROM entries GROUP BY g, pos),
kept AS (SELECT node, name, unnest(vec) AS x, unnest(range(64)) AS pos FROM nodes
         WHERE node NOT IN (SELECT node FROM members))
SELECT g::BIGINT AS node_id, name, leaves, pos::BIGINT AS pos, round(x, 6) AS value
FROM merged JOIN named USING (g) JOIN sizes USING (g)
UNION ALL SELECT node, name, 1, pos, round(x, 6) FROM kept"""

    steps, history, after = ladder(default_levels())
    sql["merge_ladder"] = f"""{steps}, levels AS ({after})
SELECT level, node AS node_id, name, leaves, pos::BIGINT AS pos, round(x, 6) AS value
FROM (SELECT level, node, name, leaves, unnest(vec) AS x, unnest(range(64)) AS pos FROM levels)"""
    sql["merge_history"] = f"{steps} {history}"
    places = ", ".join(f"({t}::DOUBLE, {n})" for n, t in enumerate(default_levels()))
    sql["merge_summary"] = f"""{steps}, h AS MATERIALIZED ({history}),
places(level, iteration) AS (VALUES {places}),
per_level AS (SELECT level, count(DISTINCT parent_id) AS n_merges, count(*) AS gone FROM h GROUP BY level)
SELECT level, iteration, n_merges, ((SELECT count(*) FROM nodes) - sum(gone - n_merges)
       OVER (ORDER BY level DESC))::BIGINT AS n_clusters_remaining
FROM per_level JOIN places USING (level)"""
    sql["lineage"] = f"""{steps}, h AS MATERIALIZED ({history}),
up(leaf_id, level, round, node_id) AS (
  SELECT node, NULL::DOUBLE, 0, node FROM nodes
  UNION ALL SELECT u.leaf_id, h.level, h.round, h.parent_id FROM up u JOIN h ON h.child_id = u.node_id)
SELECT * FROM up"""

    # Pipelines
    found = chain({"5_10": 0.6, "10_10": 0.45})
    sql["documents_to_clusters"] = f"""{found},
score AS (SELECT config, count(DISTINCT cluster_id) FILTER (cluster_id <> -1)
  / (1 + count(*) FILTER (cluster_id = -1) / greatest(1, count(*))) AS score FROM found GROUP BY config)
SELECT doc_id, file, cluster_id FROM found
WHERE config = (SELECT arg_max(config, struct_pack(a := round(score, 6), b := config = '5_10')) FROM score)"""
    sql["clusters_to_hierarchy"] = f"""{found}
SELECT row_number() OVER (ORDER BY source_config, cluster_id) - 1 AS node_id, source_config, cluster_id
FROM (SELECT DISTINCT config AS source_config, cluster_id FROM found WHERE cluster_id <> -1)"""

    # Plot data
    grid = f"""WITH p AS (SELECT embedding[1] AS x, embedding[2] AS y, cluster_id::VARCHAR AS cluster_id
                          FROM ({noisy()})),
b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p)
SELECT least(floor((x - x0) / (x1 - x0) * 1000), 999)::BIGINT AS px,
       least(floor((y - y0) / (y1 - y0) * 800), 799)::BIGINT AS py, cluster_id, count(*) AS n
FROM p, b GROUP BY ALL"""
    sql["density_grid"] = grid
    box = " UNION ALL ".join(f"""SELECT {r} AS r, count(*) / ((SELECT count(*) FROM shade) * {(2 * r + 1) ** 2 - 1.0}) AS full_
  FROM shade a JOIN shade b ON abs(a.px - b.px) <= {r} AND abs(a.py - b.py) <= {r} AND (a.px, a.py) <> (b.px, b.py)"""
                            for r in (1, 2, 3))
    sql["grid_shades"] = f"""WITH grid AS ({grid.replace("1000), 999", "100), 99").replace("800), 799", "80), 79")}),
pixel AS (SELECT px, py, sum(n)::BIGINT AS n, arg_min(cluster_id, struct_pack(a := -n, b := cluster_id)) AS cluster_id
          FROM grid GROUP BY px, py),
level AS (SELECT px, py, n, cluster_id, cume_dist() OVER (ORDER BY n) AS level FROM pixel),
shade AS MATERIALIZED (SELECT px, py, n, cluster_id, round(80 + 175 * CASE WHEN max(level) OVER () > min(level) OVER ()
    THEN (level - min(level) OVER ()) / (max(level) OVER () - min(level) OVER ()) ELSE 1 END, 6) AS alpha FROM level),
density AS ({box}),
radius AS (SELECT coalesce(min(r) FILTER (full_ > 0.7) - 1, 3) AS r FROM density),
moved AS (SELECT s.px + x AS px, s.py + y AS py, s.cluster_id, s.n, s.alpha,
    row_number() OVER (PARTITION BY s.px + x, s.py + y ORDER BY alpha DESC, n DESC, s.px, s.py) AS place
  FROM shade s, radius, range(-3, 4) AS a(x), range(-3, 4) AS b(y) WHERE x * x + y * y <= r * r)
SELECT px, py, cluster_id, n, alpha FROM moved
WHERE place = 1 AND px BETWEEN 0 AND 99 AND py BETWEEN 0 AND 79"""
    sql["hover_sample"] = f"""SELECT vec_id, round(embedding[1], 6) AS x, round(embedding[2], 6) AS y,
  cluster_id::VARCHAR AS cluster_id, 'vector ' || vec_id AS title FROM ({noisy()})
ORDER BY md5('42:' || vec_id::VARCHAR), vec_id LIMIT 200"""
    sql["color_index"] = f"""
SELECT cluster_id, row_number() OVER (ORDER BY cluster_id) - 1 AS color_index,
  CASE WHEN count(*) OVER () <= 20 THEN 'small' WHEN count(*) OVER () <= 256 THEN 'medium'
       ELSE 'large' END AS palette, cluster_id = '-1' AS is_noise
FROM (SELECT DISTINCT cluster_id::VARCHAR AS cluster_id FROM ({noisy()}))"""
    return sql
