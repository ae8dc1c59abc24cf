"""The queries over the driver's tables, one an operator or group of operators, and SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekeep import constants as K
from lorekeep import fixtures as X
from lorekeep.functions import text as T
from lorekeep.operators import extraction as E
from lorekeep.operators import graph as G
from lorekeep.operators import resolution as R
from lorekeep.operators import segments as S
from lorekeep.plans import retrieval as P
from lorekeep.streaming import incremental as I

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Words that seed the graph queries, and the ends of the path queries.
TERM_SEEDS = 6
PATH_SEEDS = ("person-1", "person-2", "event-10", "site-3", "place-asia", "person-100000000")
DETAIL_SEEDS = ("person-1", "event-10", "site-3", "artifact-5", "place-asia", "person-2")


def query(sql: str | None = None):
    """Register a function of Tables under its name, with its SQL."""

    def register(f: Callable[[X.Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, path: f(X.Tables(spark, path))
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def _ids(ids: tuple[str, ...]) -> str:
    return ", ".join(f"('{i}')" for i in ids)


def _slug(x: str) -> str:
    return f"trim(regexp_replace(lower(trim({x})), '[^a-z0-9]+', '-', 'g'), '-')"


NODES = f"""nodes AS (
  SELECT 'place-' || {_slug("r_name")} AS entity_id, 'E53_Place' AS label, r_name AS name FROM region
  UNION ALL SELECT 'place-' || {_slug("n_name")}, 'E53_Place', n_name FROM nation
  UNION ALL SELECT 'site-' || s_suppkey, 'E27_Site', s_name FROM supplier
  UNION ALL SELECT DISTINCT 'group-' || {_slug("c_mktsegment")}, 'E74_Group', c_mktsegment FROM customer
  UNION ALL SELECT 'person-' || c_custkey, 'E21_Person', c_name FROM customer
  UNION ALL SELECT 'artifact-' || p_partkey, 'E22_Man-Made_Object', p_name FROM part
  UNION ALL SELECT 'event-' || o_orderkey, 'E5_Event', 'Order ' || o_orderkey FROM orders
  UNION ALL SELECT DISTINCT 'period-' || strftime(o_orderdate, '%Y-%m'), 'E52_Time-Span', strftime(o_orderdate, '%Y-%m') FROM orders
  UNION ALL SELECT DISTINCT 'doc-' || source, 'E31_Document', source FROM documents WHERE source IS NOT NULL
)"""
EDGES = f"""edges AS (
  SELECT 'place-' || {_slug("n_name")} AS src, 'P89_FALLS_WITHIN' AS rel_type, 'place-' || {_slug("r_name")} AS dst FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'site-' || s_suppkey, 'P53_HAS_FORMER_OR_CURRENT_LOCATION', 'place-' || {_slug("n_name")} FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 'person-' || c_custkey, 'P107I_IS_CURRENT_OR_FORMER_MEMBER_OF', 'group-' || {_slug("c_mktsegment")} FROM customer
  UNION ALL SELECT 'event-' || o_orderkey, 'P11_HAD_PARTICIPANT', 'person-' || o_custkey FROM orders
  UNION ALL SELECT 'event-' || o_orderkey, 'P8_TOOK_PLACE_ON_OR_WITHIN', 'place-' || {_slug("n_name")} FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'event-' || o_orderkey, 'P4_HAS_TIME-SPAN', 'period-' || strftime(o_orderdate, '%Y-%m') FROM orders
)"""
CHUNKS = "chunks AS (SELECT source || '-' || lpad(CAST(doc_id AS VARCHAR), 6, '0') AS chunk_id, text, source AS document_name, doc_id FROM documents)"
ALIASES = r"""aliases AS (
  SELECT DISTINCT alias, 'term-' || alias AS entity_id FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+')) AS alias FROM benchmark)
  WHERE regexp_full_match(alias, '[a-z]{7,12}')
)"""
MENTIONS = r"""words AS (
  SELECT DISTINCT chunk_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+')) AS alias FROM chunks
), mentions AS (SELECT DISTINCT chunk_id, entity_id FROM words JOIN aliases USING (alias))"""
TERMS = f"seeds AS (SELECT entity_id, alias AS name FROM aliases ORDER BY alias LIMIT {TERM_SEEDS})"
DISPLAY = "CASE r " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.DISPLAY.items()) + " ELSE replace(lower(r), '_', ' ') END"
TYPE_LABEL = "CASE label " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.LABELS.items()) + " ELSE label END"


def _mentions(t: X.Tables) -> DataFrame:
    return G.mentions(X.chunks(t), X.aliases(t))


def _term_seeds(t: X.Tables) -> DataFrame:
    return X.aliases(t).orderBy("alias").limit(TERM_SEEDS).select("entity_id")


def _graph_chunks(t: X.Tables) -> DataFrame:
    """The chunks that mention most of the term seeds; only the seeds' own aliases are looked for."""
    seeds = _term_seeds(t)
    wanted = X.aliases(t).join(seeds, "entity_id", "left_semi")
    return P.graph_chunks(X.chunks(t), G.mentions(X.chunks(t), wanted), X.terms(t), seeds)


def _seeds(t: X.Tables, ids: tuple[str, ...]) -> DataFrame:
    return t.spark.createDataFrame([(i,) for i in ids], "entity_id string")


# ---- graph retrieval ------------------------------------------------------------------------


GRAPH_CHUNKS = f"""{CHUNKS}, {ALIASES}, {MENTIONS}, {TERMS}, top AS (
  SELECT chunk_id, count(DISTINCT entity_id) AS entity_count, string_agg(DISTINCT name, ',' ORDER BY name) AS mentioned
  FROM mentions JOIN seeds USING (entity_id) GROUP BY chunk_id ORDER BY entity_count DESC, chunk_id LIMIT 10
)"""


@query(f"WITH {GRAPH_CHUNKS} SELECT chunk_id, text, document_name AS source, entity_count, mentioned FROM top JOIN chunks USING (chunk_id)")
def graph_chunks_topk(t: X.Tables) -> DataFrame:
    d = _graph_chunks(t)
    return d.select("chunk_id", "text", "source", "entity_count", F.array_join("mentioned_entities", ",").alias("mentioned"))


@query(f"WITH {NODES} SELECT entity_id, name, {TYPE_LABEL} AS type, label FROM nodes WHERE entity_id IN (SELECT * FROM (VALUES {_ids(DETAIL_SEEDS)}))")
def entity_details(t: X.Tables) -> DataFrame:
    return G.details(X.nodes(t), _seeds(t, DETAIL_SEEDS))


HOP1 = f"first AS (SELECT src, rel_type, dst FROM edges WHERE src IN (SELECT * FROM (VALUES {_ids(DETAIL_SEEDS)})))"
NAMED = "SELECT DISTINCT a.name AS subject, rel_type AS relationship, b.name AS object FROM found JOIN nodes a ON a.entity_id = src JOIN nodes b ON b.entity_id = dst"


@query(f"WITH {NODES}, {EDGES}, {HOP1}, found AS (SELECT * FROM first) {NAMED}")
def subgraph_triples_1hop(t: X.Tables) -> DataFrame:
    return G.triples(X.nodes(t), X.edges(t), _seeds(t, DETAIL_SEEDS), 1)


@query(f"WITH {NODES}, {EDGES}, {HOP1}, found AS (SELECT * FROM first UNION SELECT e.src, e.rel_type, e.dst FROM first f JOIN edges e ON e.src = f.dst WHERE NOT (e.src = f.src AND e.rel_type = f.rel_type AND e.dst = f.dst)) {NAMED}")
def subgraph_triples_2hop(t: X.Tables) -> DataFrame:
    return G.triples(X.nodes(t), X.edges(t), _seeds(t, DETAIL_SEEDS), 2)


PATHS = f"""{NODES}, {EDGES}, ends AS (SELECT entity_id FROM nodes WHERE entity_id IN (SELECT * FROM (VALUES {_ids(PATH_SEEDS)}))),
step AS (SELECT src, dst, min(rel_type) AS r FROM (SELECT src, rel_type, dst FROM edges UNION ALL SELECT dst, rel_type, src FROM edges) WHERE src <> dst GROUP BY src, dst),
h1 AS (SELECT entity_id AS from_id, dst AS node, r AS p FROM ends JOIN step ON src = entity_id),
h2 AS (SELECT from_id, dst AS node, min(p || '>' || r) AS p FROM h1 JOIN step ON src = node WHERE from_id <> dst GROUP BY from_id, dst),
h3 AS (SELECT h2.from_id, s.dst AS node, min(p || '>' || r) AS p FROM h2 JOIN step s ON s.src = h2.node JOIN ends ON s.dst = entity_id GROUP BY h2.from_id, s.dst),
pairs AS (SELECT a.entity_id AS from_id, b.entity_id AS to_id FROM ends a JOIN ends b ON a.entity_id < b.entity_id),
paths AS (
  SELECT from_id, to_id, CASE WHEN h1.p IS NOT NULL THEN 1 WHEN h2.p IS NOT NULL THEN 2 WHEN h3.p IS NOT NULL THEN 3 ELSE -1 END AS hops, coalesce(h1.p, h2.p, h3.p, '') AS rels
  FROM pairs LEFT JOIN h1 USING (from_id) LEFT JOIN h2 USING (from_id) LEFT JOIN h3 USING (from_id)
)""".replace(
    "LEFT JOIN h1 USING (from_id) LEFT JOIN h2 USING (from_id) LEFT JOIN h3 USING (from_id)",
    "LEFT JOIN h1 ON h1.from_id = pairs.from_id AND h1.node = to_id LEFT JOIN h2 ON h2.from_id = pairs.from_id AND h2.node = to_id LEFT JOIN h3 ON h3.from_id = pairs.from_id AND h3.node = to_id",
).replace("SELECT from_id, to_id, CASE", "SELECT pairs.from_id, to_id, CASE")


@query(f"WITH {PATHS} SELECT from_id, to_id, CAST(hops AS INTEGER) AS hops, rels FROM paths")
def shortest_paths_3hop(t: X.Tables) -> DataFrame:
    d = G.shortest_paths(X.nodes(t), X.edges(t), _seeds(t, PATH_SEEDS))
    return d.select("from_id", "to_id", "hops", F.array_join("rel_types", ">").alias("rels"))


PATH_LINE = "CASE WHEN hops < 0 THEN 'No connection found between ' || a.name || ' and ' || b.name || ' (within 3 hops)' ELSE a.name || ' -> ' || b.name || ': connected in ' || hops || ' hop(s) via [' || list_aggregate(list_transform(string_split(rels, '>'), lambda r: " + DISPLAY + "), 'string_agg', ' -> ') || ']' END"


@query(f"WITH {PATHS} SELECT string_agg(line, chr(10) ORDER BY from_id, to_id) AS status FROM (SELECT from_id, to_id, {PATH_LINE} AS line FROM paths JOIN nodes a ON a.entity_id = from_id JOIN nodes b ON b.entity_id = to_id)")
def connection_status(t: X.Tables) -> DataFrame:
    paths = G.shortest_paths(X.nodes(t), X.edges(t), _seeds(t, PATH_SEEDS))
    return P.connection_status(P.connection_lines(paths, X.nodes(t)), len(PATH_SEEDS))


CATEGORY = "CASE label " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.CATEGORY.items()) + " ELSE 'Other' END"


@query(f"""WITH {CHUNKS}, {ALIASES}, {MENTIONS}, {NODES}, everything AS (SELECT entity_id, label, name FROM nodes WHERE label <> 'E53_Place' UNION ALL SELECT entity_id, 'E22_Man-Made_Object', alias FROM aliases),
counts AS (SELECT e.entity_id, {CATEGORY} AS category, count(chunk_id) AS n FROM everything e LEFT JOIN mentions USING (entity_id) GROUP BY ALL),
names AS (SELECT unnest([{", ".join(f"'{c}'" for c in K.CATEGORIES)}]) AS category UNION SELECT category FROM counts)
SELECT category, count(entity_id) AS n_entities, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_mentions, min_by(entity_id, (-n, entity_id)) AS first_entity FROM names LEFT JOIN counts USING (category) GROUP BY category""")
def entities_by_category(t: X.Tables) -> DataFrame:
    # Without places, so that one category is empty.
    everything = X.nodes(t).where(F.col("label") != K.PLACE).unionByName(X.terms(t))
    return G.category_totals(G.mention_counts(everything, _mentions(t)))


@query(f"WITH {NODES}, {EDGES} SELECT 'nodes' AS kind, count(*) AS n FROM nodes UNION ALL SELECT 'edges', count(*) FROM edges")
def graph_counts(t: X.Tables) -> DataFrame:
    return G.graph_counts(X.nodes(t), X.edges(t))


# ---- mentions, documents, names ---------------------------------------------------------------


@query(f"WITH {CHUNKS}, {ALIASES}, {MENTIONS} SELECT chunk_id, entity_id FROM mentions")
def mention_links(t: X.Tables) -> DataFrame:
    return _mentions(t)


@query(f"WITH {CHUNKS} SELECT DISTINCT chunk_id, 'doc-' || document_name AS entity_id FROM chunks WHERE document_name IS NOT NULL")
def chunk_documents(t: X.Tables) -> DataFrame:
    c = X.chunks(t)
    return G.chunk_documents(c, G.document_nodes(c))


def _named(t: X.Tables) -> DataFrame:
    """Parts as entities: names repeat and are aliases of each other by brand."""
    return t.part.select(F.concat(F.lit("artifact-"), F.col("p_partkey").cast("string")).alias("entity_id"), F.col("p_name").alias("name"), F.array("p_brand", "p_type").alias("aliases"), F.col("p_partkey").alias("seq"))


@query("""WITH n AS (
  SELECT 'artifact-' || p_partkey AS id, lower(p_name) AS alias, 0 AS kind, -p_partkey AS k FROM part
  UNION ALL SELECT 'artifact-' || p_partkey, lower(p_brand), 1, p_partkey FROM part
  UNION ALL SELECT 'artifact-' || p_partkey, lower(p_type), 1, p_partkey FROM part
) SELECT alias, min_by(id, (kind, k)) AS entity_id FROM n GROUP BY alias""")
def alias_map(t: X.Tables) -> DataFrame:
    return R.alias_map(_named(t))


@query("SELECT p_brand, min_by(p_name, (-length(p_name), p_name)) AS name FROM part GROUP BY p_brand")
def canonical_name(t: X.Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(R.longest("p_name").alias("name"))


@query(r"""WITH s AS (
  SELECT source, doc_id, unnest(parts) AS s, unnest(range(len(parts))) AS i
  FROM (SELECT source, doc_id, string_split(regexp_replace(trim(text, E' \n\t'), '([.!?])\s+', E'\\1\x01', 'g'), chr(1)) AS parts FROM documents)
), f AS (
  SELECT source, lower(trim(s, E' \n\t')) AS k, min_by(trim(s, E' \n\t'), (doc_id, i)) AS v, min((doc_id, i)) AS place FROM s WHERE trim(s, E' \n\t') <> '' GROUP BY ALL
) SELECT source, place[1] AS doc_id, CAST(place[2] AS INTEGER) AS place, v AS sentence FROM f""")
def merge_descriptions(t: X.Tables) -> DataFrame:
    # Every sentence of every document, as rows: one string for a source would grow with the corpus.
    return R.description_sentences(t.documents, ["source"], ["doc_id"], "text")


MESSY = "CASE p_partkey % 3 WHEN 0 THEN '  The  ' || p_name || ' ' WHEN 1 THEN 'an ' || upper(p_name) ELSE p_name || '!  (' || p_brand || ')' END"


def _messy() -> F.Column:
    return F.expr("CASE p_partkey % 3 WHEN 0 THEN '  The  ' || p_name || ' ' WHEN 1 THEN 'an ' || upper(p_name) ELSE p_name || '!  (' || p_brand || ')' END")


@query(rf"SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(trim({MESSY})), '^(the|a|an)\s+', ''), '\s+', ' ', 'g')) AS name FROM part")
def normalize_names(t: X.Tables) -> DataFrame:
    return t.part.select("p_partkey", T.normalized(_messy()).alias("name"))


@query(f"SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'site-' ELSE 'unknown-' END || {_slug(MESSY)} AS entity_id, substr({_slug(MESSY)}, 1, 12) AS short_slug FROM part")
def slug_entity_ids(t: X.Tables) -> DataFrame:
    kind = F.when(F.col("p_partkey") % 2 == 0, K.SITE).otherwise("Unknown")
    return t.part.select("p_partkey", T.entity_id(kind, _messy()).alias("entity_id"), T.slug(_messy(), 12).alias("short_slug"))


@query(f"SELECT DISTINCT rel_type, {DISPLAY.replace(' r ', ' rel_type ').replace('lower(r)', 'lower(rel_type)')} AS shown FROM (SELECT unnest([{', '.join(repr(r[0]) for r in K.RELATIONS)}, 'NOT_A_KNOWN_RELATION']) AS rel_type)")
def display_labels(t: X.Tables) -> DataFrame:
    names = [(r[0],) for r in K.RELATIONS] + [("NOT_A_KNOWN_RELATION",)]
    return t.spark.createDataFrame(names, "rel_type string").select("rel_type", T.display(F.col("rel_type")).alias("shown"))


@query(f"WITH {NODES} SELECT entity_id, name || ' (' || {TYPE_LABEL} || ')' || CASE WHEN label = 'E53_Place' THEN '. ' || label ELSE '' END AS description, 'search_document: ' || name AS prompt FROM nodes")
def entity_descriptions(t: X.Tables) -> DataFrame:
    note = F.when(F.col("label") == K.PLACE, F.col("label"))
    return X.nodes(t).select("entity_id", T.entity_description(F.col("label"), F.col("name"), note).alias("description"), T.for_document(F.col("name")).alias("prompt"))


# ---- text ---------------------------------------------------------------------------------------

#: Noise for every rule, put before and into each document's text.
NOISE = r"\n## INDIAN WARS. xii\n32 INDIAN WARS.\n## INDIAN WARS. 33\n12.\n\n\n\n\nvi INTRODUCTION.\nxii THE PREFACE. \nv/ater Vvise vvise it\'s in\-to on \ - off happyy day  \n"
_BACK = "\\"


def _noisy() -> F.Column:
    return F.concat(F.lit(NOISE.replace(_BACK + "n", "\n")), F.coalesce("text", F.lit("")))


def _rule_sql(name: str, x: str) -> str:
    """A clean-up rule for the oracle, whose regular expressions have ASCII word boundaries only."""
    pattern, new = next((p, r) for n, p, r in T.RULES if n == name)
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    line = lambda s: s.replace("\n", "' || chr(10) || '")
    if name == "double_y":
        return rf"regexp_replace({x}, '([a-zA-Z])yy([^\p{{L}}\p{{N}}_]|$)', '\1y\2', 'g')"
    if name == "final_newline":
        return f"rtrim({x}, chr(10)) || chr(10)"
    if name == "images":
        return x
    if pattern.startswith("="):
        return f"replace({x}, {quote(pattern[1:])}, {quote(new)})"
    return f"regexp_replace({x}, {quote(pattern.replace('(?md)', '(?m)'))}, {line(quote(new.replace('$', _BACK)))}, 'g')"


def _cleaned_sql() -> str:
    x = f"({line_literal(NOISE)} || coalesce(text, ''))"
    for name, _, _ in T.RULES:
        x = _rule_sql(name, x)
    return x


def line_literal(s: str) -> str:
    return "'" + s.replace("'", "''").replace(_BACK + "n", "' || chr(10) || '") + "'"


@query(f"SELECT doc_id, {_cleaned_sql()} AS text FROM documents")
def ocr_clean(t: X.Tables) -> DataFrame:
    return t.texts.select("doc_id", T.clean(_noisy()).alias("text"))


def _one_rule(name: str):
    noisy = f"({line_literal(NOISE)} || coalesce(text, ''))"

    def run(t: X.Tables) -> DataFrame:
        return t.texts.select("doc_id", F.md5(T.rule(name, _noisy())).alias("digest"))

    run.__name__ = f"ocr_rule_{name}"
    return query(f"SELECT doc_id, md5({_rule_sql(name, noisy)}) AS digest FROM documents")(run)


for _name, _, _ in T.RULES:
    _one_rule(_name)


_IMAGES = "repeat(chr(10) || '![Image 1 (page 1)](embedded:x)', CAST(40 + page_id % 25 AS INTEGER))"


@query(f"SELECT page_id, CASE WHEN page_id % 25 > 10 AND page_id % 2 = 1 THEN url || chr(10) ELSE CASE WHEN page_id % 2 = 0 THEN '' ELSE url || '  ' END || {_IMAGES} END AS text FROM pages")
def image_block_cut(t: X.Tables) -> DataFrame:
    images = F.expr("repeat('\\n![Image 1 (page 1)](embedded:x)', CAST(40 + page_id % 25 AS INT))")
    text = F.concat(F.when(F.col("page_id") % 2 == 0, "").otherwise(F.concat("url", F.lit("  "))), images)
    return t.pages.select("page_id", T.cut_images(text).alias("text"))


@query(r"""SELECT doc_id, CAST(unnest(range(len(p))) AS INTEGER) AS pos, unnest(p) AS piece
FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\n'), lambda x: trim(x, E' \n\t\r')), lambda x: x <> '') AS p FROM documents)""")
def split_paragraphs(t: X.Tables) -> DataFrame:
    # Documents have single newlines; doubled, they are paragraphs.
    return S.split_text(t.documents, T.paragraphs(F.regexp_replace("text", "\n", "\n\n")), "doc_id")


#: White space as Unicode has it, for regular expressions and for trimming.
_BLANK = r"[\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query(rf"""WITH p AS (SELECT doc_id, string_split(regexp_replace(text, '(\.{_BLANK})([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS p FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, list_filter(list_transform(p, lambda x: regexp_replace(x, '^{_BLANK}+|{_BLANK}+$', '', 'g')), lambda x: x <> '') AS p FROM p)
SELECT doc_id, CAST(unnest(range(len(p))) AS INTEGER) AS pos, unnest(p) AS piece FROM s""")
def split_sentences(t: X.Tables) -> DataFrame:
    return S.split_text(t.documents, T.sentences(F.col("text")), "doc_id")


def _structured(t: X.Tables) -> DataFrame:
    """Documents with paragraphs, every fourth of them under a heading."""
    lines = F.split("text", "\n")
    marked = F.transform(lines, lambda x, i: F.when(i % 4 == 0, F.concat(F.lit("## "), x)).otherwise(x))
    return t.texts.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("doc_name"), F.array_join(marked, "\n\n").alias("text"), "doc_id", "source")


def _paged(t: X.Tables) -> DataFrame:
    """Twenty documents at a time as the pages of one."""
    page = F.concat(F.lit("<!-- PAGE "), (F.col("doc_id") % 20 + 1).cast("string"), F.lit(" -->\n\n"), F.coalesce("text", F.lit("")))
    listed = F.array_sort(F.collect_list(F.struct("doc_id", page.alias("p"))))
    book = F.concat(F.lit("book-"), F.floor(F.col("doc_id") / 20).cast("string")).alias("doc_name")
    return _structured(t).groupBy(book).agg(F.array_join(F.transform(listed, lambda s: s.p), "\n\n").alias("text"))


@query()
def page_sections(t: X.Tables) -> DataFrame:
    return S.sections(_paged(t), "pages")


@query()
def heading_sections(t: X.Tables) -> DataFrame:
    return S.sections(_structured(t), "headings")


@query()
def relation_sections(t: X.Tables) -> DataFrame:
    return S.sections(_structured(t), "relations")


@query()
def chunk_documents_text(t: X.Tables) -> DataFrame:
    return S.chunked(_structured(t))


@query()
def chunk_stats(t: X.Tables) -> DataFrame:
    return S.chunk_stats(S.chunked(_structured(t)))


WINDOWS = """d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, l, len(l) AS n, unnest(range(0, len(l), 8)) AS a FROM d)"""


@query(f"WITH {WINDOWS} SELECT doc_id, CAST(a // 8 AS INTEGER) AS \"window\", CAST(a AS INTEGER) AS first, CAST(least(a + 10, n) AS INTEGER) AS \"end\", array_to_string(l[a + 1 : least(a + 10, n)], chr(10)) AS lines FROM w")
def line_windows(t: X.Tables) -> DataFrame:
    d = S.windows(t.documents, "doc_id", size=10, overlap=2)
    return d.select(F.col("doc_name").alias("doc_id"), "window", "first", "end", F.array_join("lines", "\n").alias("lines"))


@query("SELECT doc_id, text FROM documents WHERE text IS NOT NULL")
def window_reassembly(t: X.Tables) -> DataFrame:
    return S.reassembled(S.windows(t.documents, "doc_id", size=10, overlap=2), 10, 2).withColumnRenamed("doc_name", "doc_id")


# ---- extraction -----------------------------------------------------------------------------------


def _raw_entities(t: X.Tables) -> DataFrame:
    """A part as a model's answer, spoilt in a way that its number decides."""
    kind = F.expr("element_at(array('E22_Man-Made_Object', 'Artifact', 'Man-Made_Object', 'Widget', 'E31_Document'), CAST(p_partkey % 5 AS INT) + 1)")
    name = F.when(F.col("p_partkey") % 7 == 6, "  ").otherwise(F.concat(F.lit(" "), "p_name"))
    confidence = F.when(F.col("p_partkey") % 11 == 0, F.lit("high")).otherwise((F.col("p_size") / 10).cast("string"))
    item = F.to_json(F.struct(name.alias("name"), kind.alias("type"), F.array("p_brand", F.lit(" ")).alias("aliases"), F.col("p_type").alias("description"), confidence.alias("confidence")))
    raw = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("["), item, F.lit(",]"))).when(F.col("p_partkey") % 3 == 1, item).otherwise(F.concat(F.lit("Here it is: ["), item, F.lit("] as asked")))
    return t.part.select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("section_id"), raw.alias("raw_json"))


@query(r"""SELECT 'part-' || p_partkey AS source_section, CASE WHEN p_partkey % 7 = 6 THEN '' ELSE trim(p_name) END AS name,
  CASE p_partkey % 5 WHEN 3 THEN NULL WHEN 4 THEN 'E31_Document' ELSE 'E22_Man-Made_Object' END AS entity_type, p_brand AS aliases, p_type AS description,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, p_size / 10.0::DOUBLE)) END AS confidence,
  CASE WHEN p_partkey % 5 = 3 THEN 'unknown type' WHEN p_partkey % 5 = 4 THEN 'not proposed' WHEN p_partkey % 7 = 6 THEN 'no name' WHEN p_partkey % 11 = 0 THEN 'bad confidence' ELSE 'ok' END AS status
FROM part""")
def parse_entities_json(t: X.Tables) -> DataFrame:
    return E.parsed_entities(_raw_entities(t)).withColumn("aliases", F.array_join("aliases", ","))


def _candidates(t: X.Tables) -> DataFrame:
    """Orders as proposed relations to their customers, spoilt in a way that the key decides."""
    k = F.col("o_orderkey") % 10
    name = F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"))
    d = t.orders.join(t.customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    return d.select(
        "o_orderkey",
        F.when(k == 1, "").when(k == 2, F.upper(name)).otherwise(name).alias("head_name"),
        F.when(k == 3, K.PLACE).otherwise(K.EVENT).alias("head_type"),
        F.when(k == 4, "MENTIONS").otherwise("P11_HAD_PARTICIPANT").alias("relation_type"),
        F.when(k == 5, "Nobody").when(k == 6, F.lower("c_name")).otherwise(F.col("c_name")).alias("tail_name"),
        F.when(k == 7, K.SITE).otherwise(K.PERSON).alias("tail_type"),
        F.when(k == 8, 0.49).when(k == 9, F.lit(None)).otherwise(0.5 + k / 10).cast("double").alias("confidence"),
    )


@query("""SELECT o_orderkey, CASE o_orderkey % 10 WHEN 1 THEN '' ELSE 'Order ' || o_orderkey END AS head_name,
  CASE o_orderkey % 10 WHEN 5 THEN 'Nobody' ELSE c_name END AS tail_name,
  CASE o_orderkey % 10 WHEN 9 THEN 'unparsable' WHEN 1 THEN 'missing name' WHEN 4 THEN 'relation type' WHEN 8 THEN 'low confidence' WHEN 3 THEN 'head type' WHEN 7 THEN 'tail type' WHEN 5 THEN 'tail unknown' END AS reject_reason
FROM orders JOIN customer ON o_custkey = c_custkey""")
def validate_relations(t: X.Tables) -> DataFrame:
    names = t.orders.select(F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("name")).unionAll(t.customer.select("c_name"))
    return E.validated(_candidates(t), names).select("o_orderkey", "head_name", "tail_name", "reject_reason")


@query("""WITH n AS (
  SELECT p_brand AS doc_name, p_name AS name, p_partkey AS seq, 0 AS k FROM part UNION ALL SELECT p_brand, p_type, p_partkey, 1 FROM part
), f AS (SELECT doc_name, name, min((seq, k)) AS at FROM n GROUP BY ALL) SELECT doc_name, string_agg(name, '|' ORDER BY at) AS names FROM f GROUP BY doc_name""")
def names_by_document(t: X.Tables) -> DataFrame:
    e = t.part.select(F.col("p_brand").alias("doc_name"), F.col("p_partkey").alias("seq"), F.col("p_name").alias("name"), F.array("p_type").alias("aliases"))
    return E.names_by_document(e).withColumn("names", F.array_join("names", "|"))


@query("""SELECT 'part-' || p_partkey AS source_section, p_name AS head_name, 'E22_Man-Made_Object' AS head_type, 'P45_CONSISTS_OF' AS relation_type, p_type AS tail_name, '' AS tail_type,
  CASE p_partkey % 3 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN p_size::DOUBLE END AS confidence FROM part""")
def parse_relations_json(t: X.Tables) -> DataFrame:
    # Half of the answers are fenced, the others go on from an opened array and are fenced at the end.
    confidence = F.when(F.col("p_partkey") % 3 == 1, F.col("p_size").cast("string")).when(F.col("p_partkey") % 3 == 2, "sure")
    item = F.to_json(F.struct(F.concat(F.lit(" "), "p_name").alias("head_name"), F.lit(K.ARTIFACT).alias("head_type"), F.lit("P45_CONSISTS_OF").alias("relation_type"), F.concat("p_type", F.lit(" ")).alias("tail_name"), confidence.alias("confidence")))
    fenced = E.unfenced(F.concat(F.lit("```json\n["), item, F.lit("]\n```")))
    opened = E.prefilled(E.unfenced(F.concat(item, F.lit("]\n```\n")), "end"))
    raw = F.when(F.col("p_partkey") % 2 == 0, fenced).otherwise(opened)
    return E.parsed_relations(t.part.select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("section_id"), raw.alias("raw_json")))


@query(r"""SELECT doc_id, source AS doc_name FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '[^\s]') AND source IN (SELECT source FROM documents JOIN labels USING (doc_id) WHERE quality = 1)""")
def sections_to_relate(t: X.Tables) -> DataFrame:
    sections = t.documents.select("doc_id", F.col("source").alias("doc_name"), "text")
    entities = t.documents.join(t.labels.where("quality = 1").select("doc_id"), "doc_id").select(F.col("source").alias("doc_name"))
    return E.to_extract(sections, entities).select("doc_id", "doc_name")


@query("SELECT doc_id, array_to_string(string_split(text, chr(10))[1:3], chr(10)) AS preview, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_rows FROM documents WHERE text IS NOT NULL")
def table_preview(t: X.Tables) -> DataFrame:
    rows = F.transform(F.split("text", "\n"), lambda x: F.array(x))
    d = E.table_preview(t.documents.where("text is not null").select("doc_id", rows.alias("rows")))
    return d.select("doc_id", F.array_join(F.flatten("preview"), "\n").alias("preview"), "n_rows")


# ---- resolution -------------------------------------------------------------------------------------


def _variants(t: X.Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("seq"), F.col("p_brand").alias("doc_name"), F.col("p_name").alias("name"), F.lit(K.ARTIFACT).alias("entity_type"), F.array().cast("array<string>").alias("aliases"), F.col("p_type").alias("description"))


@query("SELECT p_partkey AS seq, min(p_partkey) OVER (PARTITION BY lower(p_name)) AS cluster FROM part")
def resolve_exact(t: X.Tables) -> DataFrame:
    return R.exact_clusters(_variants(t)).select("seq", "cluster")


@query("""SELECT p_partkey AS seq, min(p_partkey) OVER (PARTITION BY p_brand) AS cluster FROM part""")
def resolve_by_alias(t: X.Tables) -> DataFrame:
    # Different names that share one alias, the brand, are one cluster: that of the first of them.
    return R.exact_clusters(_variants(t).withColumn("name", F.concat(F.lit("part "), F.col("seq").cast("string"))).withColumn("aliases", F.array("doc_name"))).select("seq", "cluster")


@query()
def resolve_fuzzy(t: X.Tables) -> DataFrame:
    return R.resolve(_variants(t))[0].withColumns({"aliases": F.array_join("aliases", "|"), "sources": F.array_join("sources", "|")})


@query()
def ambiguous_pairs(t: X.Tables) -> DataFrame:
    return R.resolve(_variants(t))[1]


# ---- loading ----------------------------------------------------------------------------------------


def _relations(t: X.Tables) -> DataFrame:
    """Line items as relations: the order is the head, the supplier the tail, the key pair repeats."""
    return t.lineitem.select(
        F.concat(F.lit("event-"), F.col("l_orderkey").cast("string")).alias("head_id"),
        F.lit("P8_TOOK_PLACE_ON_OR_WITHIN").alias("relation_type"),
        F.when(F.col("l_suppkey") % 9 != 0, F.concat(F.lit("site-"), (F.col("l_suppkey") % 5).cast("string"))).alias("tail_id"),
        F.col("l_discount").alias("confidence"),
        F.col("l_shipdate").cast("date").cast("string").alias("source_section"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("at"),
        F.col("l_returnflag").alias("tail_name"),
    )


@query("""SELECT 'event-' || l_orderkey AS src, 'P8_TOOK_PLACE_ON_OR_WITHIN' AS rel_type, 'site-' || (l_suppkey % 5) AS dst,
  arg_max(l_discount, (l_shipdate, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax)) AS confidence,
  arg_max(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), (l_shipdate, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax)) AS source_section
FROM lineitem WHERE l_suppkey % 9 <> 0 GROUP BY l_orderkey, l_suppkey % 5""")
def load_edges_upsert(t: X.Tables) -> DataFrame:
    return G.edges(_relations(t), [F.col("at")])


@query("""SELECT 'event-' || l_orderkey AS entity_id, string_agg(l_returnflag, ', ' ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag) AS "P45_CONSISTS_OF", CAST(NULL AS VARCHAR) AS "P101_HAD_AS_GENERAL_USE"
FROM lineitem GROUP BY l_orderkey""")
def load_property_values(t: X.Tables) -> DataFrame:
    r = _relations(t).withColumn("relation_type", F.lit("P45_CONSISTS_OF"))
    return G.property_values(r, [F.col("at")])


@query("SELECT count(*) FILTER (l_suppkey % 9 <> 0) AS edges, 0::BIGINT AS properties, count(*) FILTER (l_suppkey % 9 = 0) AS skipped FROM lineitem")
def load_counts(t: X.Tables) -> DataFrame:
    return G.load_counts(_relations(t))


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(t: X.Tables) -> DataFrame:
    return G.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""SELECT 'size-' || p_size AS entity_id, 'E22_Man-Made_Object' AS label, p_name AS name, p_type AS "P3_has_note", p_brand AS aliases
FROM part QUALIFY row_number() OVER (PARTITION BY p_size ORDER BY p_partkey DESC) = 1""")
def load_nodes_upsert(t: X.Tables) -> DataFrame:
    e = t.part.select(F.concat(F.lit("size-"), F.col("p_size").cast("string")).alias("entity_id"), F.lit(K.ARTIFACT).alias("entity_type"), F.col("p_name").alias("name"), F.col("p_type").alias("description"), F.array("p_brand").alias("aliases"), F.col("p_partkey").alias("seq"))
    return G.nodes(e).withColumn("aliases", F.array_join("aliases", ","))


@query("""WITH ids AS (SELECT lower(p_name) AS l, arg_max('artifact-' || p_partkey, p_partkey) AS id FROM part GROUP BY 1),
r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN upper(h.p_name) ELSE h.p_name END AS head, CASE WHEN l_linenumber = 7 THEN 'nobody' ELSE t.p_name END AS tail, l_discount, l_returnflag, l_extendedprice, l_tax, l_quantity
  FROM lineitem JOIN part h ON l_partkey = h.p_partkey JOIN part t ON l_suppkey = t.p_partkey)
SELECT a.id AS src, 'P89_FALLS_WITHIN' AS rel_type, b.id AS dst, arg_max(l_discount, (l_orderkey, l_linenumber, l_extendedprice, l_tax, l_quantity, l_discount)) AS confidence,
  arg_max(l_returnflag, (l_orderkey, l_linenumber, l_extendedprice, l_tax, l_quantity, l_discount, l_returnflag)) AS source_section
FROM r JOIN ids a ON lower(head) = a.l JOIN ids b ON lower(tail) = b.l GROUP BY 1, 3""")
def load_relations_by_name(t: X.Tables) -> DataFrame:
    entities = t.part.select(F.concat(F.lit("artifact-"), F.col("p_partkey").cast("string")).alias("entity_id"), F.col("p_name").alias("name"), F.col("p_partkey").alias("seq"))
    line = F.col("l_linenumber")
    r = t.lineitem.join(t.part.select(F.col("p_partkey").alias("_h"), F.col("p_name").alias("_hn")), F.col("l_partkey") == F.col("_h")).join(t.part.select(F.col("p_partkey").alias("_t"), F.col("p_name").alias("_tn")), F.col("l_suppkey") == F.col("_t"))
    r = r.select(
        F.when(line % 2 == 0, F.upper("_hn")).otherwise(F.col("_hn")).alias("head_name"),
        F.lit("P89_FALLS_WITHIN").alias("relation_type"),
        F.when(line == 7, "nobody").otherwise(F.col("_tn")).alias("tail_name"),
        F.col("l_discount").alias("confidence"),
        F.col("l_returnflag").alias("source_section"),
        F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_tax", "l_quantity", "l_discount", "l_returnflag").alias("at"),
    )
    return G.edges(G.resolved(r, entities), [F.col("at")])


@query("SELECT 'event-' || l_orderkey AS src, 'P8_TOOK_PLACE_ON_OR_WITHIN' AS rel_type, 'site-' || (l_suppkey % 40) AS dst FROM lineitem WHERE l_suppkey % 40 IN (SELECT s_suppkey FROM supplier) AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0)")
def connected_edges(t: X.Tables) -> DataFrame:
    e = t.lineitem.select(F.concat(F.lit("event-"), F.col("l_orderkey").cast("string")).alias("src"), F.lit("P8_TOOK_PLACE_ON_OR_WITHIN").alias("rel_type"), F.concat(F.lit("site-"), (F.col("l_suppkey") % 40).cast("string")).alias("dst"))
    n = t.supplier.select(F.concat(F.lit("site-"), F.col("s_suppkey").cast("string")).alias("entity_id")).unionAll(t.orders.where("o_orderkey % 3 = 0").select(F.concat(F.lit("event-"), F.col("o_orderkey").cast("string"))))
    return G.connected(e, n)


@query("""SELECT 'c-' || (doc_id % 97) AS chunk_id, text, source AS document_name, lang AS section_heading, doc_id AS chunk_index
FROM documents QUALIFY row_number() OVER (PARTITION BY doc_id % 97 ORDER BY doc_id DESC) = 1""")
def load_chunks_upsert(t: X.Tables) -> DataFrame:
    c = t.documents.select(F.concat(F.lit("c-"), (F.col("doc_id") % 97).cast("string")).alias("chunk_id"), "text", F.col("source").alias("document_name"), F.col("lang").alias("section_heading"), F.col("doc_id").alias("chunk_index"))
    return G.chunk_nodes(c, [F.col("chunk_index")])


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'new ' || source ELSE source END AS source, CASE WHEN doc_id % 3 = 0 THEN lang END AS lang FROM documents WHERE doc_id % 3 = 0 OR doc_id % 2 = 0")
def reload_upsert(t: X.Tables) -> DataFrame:
    old = t.documents.where("doc_id % 2 = 0").select("doc_id", "source")
    new = t.documents.where("doc_id % 3 = 0").select("doc_id", F.concat(F.lit("new "), "source").alias("source"), "lang")
    return G.upserted(old, new, ["doc_id"])


@query("""SELECT d.doc_id, CASE WHEN e.vec_id % 3 = 0 THEN round(-CAST(e.embedding[1] AS DOUBLE), 6) WHEN e.vec_id % 2 = 0 THEN round(CAST(e.embedding[1] AS DOUBLE), 6) END AS first
FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id""")
def embedding_writeback(t: X.Tables) -> DataFrame:
    v = t.embeddings.withColumnRenamed("vec_id", "doc_id")
    had = t.documents.select("doc_id").join(v.where("doc_id % 2 = 0").select("doc_id", "embedding"), "doc_id", "left")
    new = v.where("doc_id % 3 = 0").select("doc_id", F.transform("embedding", lambda x: -x).alias("embedding"))
    return G.with_vectors(had, new, "doc_id").select("doc_id", F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first"))


@query("SELECT count(*) AS rows, count(embedding) AS embedded, CAST(coalesce(max(len(embedding)), 0) AS INTEGER) AS dimension FROM documents LEFT JOIN embeddings ON doc_id = vec_id")
def vector_report(t: X.Tables) -> DataFrame:
    v = t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding")
    return G.vector_report(t.documents.select("doc_id").join(v, "doc_id", "left"))


@query("""WITH e AS (SELECT p_brand AS doc_name, count(*) AS n FROM part GROUP BY 1), r AS (SELECT p_mfgr AS doc_name, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT coalesce(e.doc_name, r.doc_name) AS doc_name, coalesce(e.n, 0) AS n_entities, coalesce(r.n, 0) AS n_relations FROM e FULL JOIN r ON e.doc_name = r.doc_name""".replace("p_mfgr", "p_type"))
def document_totals(t: X.Tables) -> DataFrame:
    relations = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_type").alias("doc_name"))
    return G.document_totals(t.part.select(F.col("p_brand").alias("doc_name")), relations)


@query("""SELECT DISTINCT vec_id AS chunk_id, 'site-' || (vec_id % 30) AS entity_id FROM embeddings
WHERE vec_id IN (SELECT doc_id FROM documents WHERE doc_id % 2 = 0) AND vec_id % 30 IN (SELECT s_suppkey FROM supplier)""")
def load_mentions(t: X.Tables) -> DataFrame:
    pairs = t.embeddings.select(F.col("vec_id").alias("chunk_id"), F.concat(F.lit("site-"), (F.col("vec_id") % 30).cast("string")).alias("entity_id"))
    n = t.supplier.select(F.concat(F.lit("site-"), F.col("s_suppkey").cast("string")).alias("entity_id"))
    return G.linked_mentions(pairs, t.documents.where("doc_id % 2 = 0").select(F.col("doc_id").alias("chunk_id")), n)


# ---- vectors, merge, prompts --------------------------------------------------------------------------

VECTORS = """q AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 0),
scored AS (SELECT chunk_id, text, document_name AS source, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), q) AS score FROM embeddings JOIN chunks ON vec_id = doc_id, q)"""


def _nearest(t: X.Tables, exclude: bool = False) -> DataFrame:
    v, c = X.vectors(t), X.chunks(t)
    if exclude:
        v = v.where("vec_id <> 0")
    return P.vector_chunks(c, v, t.embeddings.where("vec_id = 0"))


@query(f"WITH {CHUNKS}, {VECTORS} SELECT chunk_id, source, round(score, 6) AS score FROM scored ORDER BY scored.score DESC, chunk_id LIMIT 10")
def vector_topk(t: X.Tables) -> DataFrame:
    return _nearest(t).select("chunk_id", "source", F.round("score", 6).alias("score"))


@query(f"WITH {CHUNKS}, {VECTORS} SELECT chunk_id, source, round(score, 6) AS score FROM scored WHERE vec_id <> 0 ORDER BY scored.score DESC, chunk_id LIMIT 10")
def vector_topk_exclude_self(t: X.Tables) -> DataFrame:
    return _nearest(t, True).select("chunk_id", "source", F.round("score", 6).alias("score"))


@query(f"""WITH {CHUNKS}, q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id % 50 = 0),
scored AS (SELECT query_id, chunk_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), q) AS score FROM embeddings JOIN chunks ON vec_id = doc_id, q)
SELECT query_id, chunk_id, round(score, 6) AS score FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY scored.score DESC, chunk_id) <= 10""")
def vector_topk_each(t: X.Tables) -> DataFrame:
    queries = t.embeddings.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return P.vector_chunks_each(X.vectors(t), queries).withColumn("score", F.round("score", 6))


@query()
def vector_topk_index(t: X.Tables) -> DataFrame:
    queries = t.embeddings.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    index, centres = P.vector_index(X.vectors(t))
    return P.search_index(index, centres, queries, probes=max(1, centres.count() // 2)).withColumn("score", F.round("score", 6))


@query(f"""WITH {CHUNKS}, {ALIASES}, {MENTIONS}, {VECTORS}, found AS (SELECT chunk_id FROM scored WHERE vec_id <> 0 ORDER BY score DESC, chunk_id LIMIT 10)
SELECT entity_id, alias AS name, count(DISTINCT chunk_id) AS n_chunks FROM found JOIN mentions USING (chunk_id) JOIN aliases USING (entity_id) GROUP BY ALL""")
def similar_chunk_entities(t: X.Tables) -> DataFrame:
    return P.entities_of(_nearest(t, True), _mentions(t), X.terms(t))


MERGED = f"""{GRAPH_CHUNKS}, {VECTORS},
near AS (SELECT chunk_id, score FROM scored WHERE vec_id <> 0 ORDER BY score DESC, chunk_id LIMIT 10),
g AS (SELECT chunk_id, entity_count / (max(entity_count) OVER ())::DOUBLE AS share, row_number() OVER (ORDER BY entity_count DESC, chunk_id) AS rg FROM top),
v AS (SELECT chunk_id, score, row_number() OVER (ORDER BY score DESC, chunk_id) AS rv FROM near),
m AS (SELECT chunk_id, CASE WHEN share IS NOT NULL AND score IS NOT NULL THEN share + score + 0.3::DOUBLE ELSE coalesce(share, score) END AS total,
  CASE WHEN share IS NOT NULL AND score IS NOT NULL THEN 'both' WHEN share IS NOT NULL THEN 'graph' ELSE 'vector' END AS origin, rg, rv FROM g FULL JOIN v USING (chunk_id))"""


def _merged(t: X.Tables) -> DataFrame:
    graph = _graph_chunks(t)
    return P.merged_chunks(graph, _nearest(t, True))


@query(f"WITH {MERGED} SELECT chunk_id, origin, round(total, 6) AS score FROM m ORDER BY total DESC, rg IS NULL, coalesce(rg, rv) LIMIT 10")
def hybrid_merge(t: X.Tables) -> DataFrame:
    return _merged(t).select("chunk_id", "origin", F.round("score", 6).alias("score"))


@query(f"WITH {GRAPH_CHUNKS} SELECT CAST(row_number() OVER (ORDER BY entity_count DESC, chunk_id) AS INTEGER) AS rank, '[' || row_number() OVER (ORDER BY entity_count DESC, chunk_id) || '] Source: ' || document_name || chr(10) || trim(text, E' \\n\\t\\r') AS line FROM top JOIN chunks USING (chunk_id)")
def prompt_sources(t: X.Tables) -> DataFrame:
    d = _graph_chunks(t)
    return P.source_lines(d, [F.desc("entity_count"), F.col("chunk_id")], False)


SECTIONS = f"""{NODES}, {EDGES}, {HOP1}, found AS (SELECT * FROM first), t AS ({NAMED}),
s AS (SELECT subject, string_agg('  - ' || subject || ' — ' || ({DISPLAY.replace("CASE r ", "CASE relationship ").replace("lower(r)", "lower(relationship)")}) || ' — ' || object, chr(10) ORDER BY relationship, object) AS l FROM t GROUP BY subject)"""


@query(f"WITH {SECTIONS.replace('nodes AS (', 'nodes AS MATERIALIZED (').replace('edges AS (', 'edges AS MATERIALIZED (').replace('s AS (SELECT subject', 's AS MATERIALIZED (SELECT subject')}, picked AS MATERIALIZED (SELECT entity_id, label, name FROM nodes WHERE entity_id IN (SELECT * FROM (VALUES {_ids(DETAIL_SEEDS)}))) SELECT entity_id, '### Entity: ' || name || ' (' || {TYPE_LABEL} || ')' || chr(10) || 'Graph connections:' || coalesce(chr(10) || l, ' (none retrieved)') AS section FROM picked LEFT JOIN s ON name = subject")
def prompt_entities(t: X.Tables) -> DataFrame:
    seeds = _seeds(t, DETAIL_SEEDS)
    return P.entity_sections(G.details(X.nodes(t), seeds), G.triples(X.nodes(t), X.edges(t), seeds, 1))


@query()
def prompt_full(t: X.Tables) -> DataFrame:
    seeds = _seeds(t, DETAIL_SEEDS)
    sections = P.entity_sections(G.details(X.nodes(t), seeds), G.triples(X.nodes(t), X.edges(t), seeds))
    merged = _merged(t)
    sources = P.source_lines(merged, [F.desc("score"), F.col("chunk_id")], True)
    return P.prompt("which finds are alike?", sections, sources, connection_status(t))


# ---- increments, shapes, events ------------------------------------------------------------------------


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings WHERE embedding IS NOT NULL)")
def missing_embeddings(t: X.Tables) -> DataFrame:
    v = t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding")
    return G.without_vector(t.documents.select("doc_id"), v, "doc_id")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def incremental_docs(t: X.Tables) -> DataFrame:
    return I.pending(t.documents.select("doc_id", "source"), t.labels, "doc_id")


def _faulty(t: X.Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The graph with faults: orders without a time, one nation in two regions, a person at a place, a bad type."""
    e = X.edges(t)
    every = F.regexp_extract("src", r"(\d+)$", 1).cast("long") % 100 == 0
    e = e.where(~((F.col("rel_type") == "P4_HAS_TIME-SPAN") & every))
    extra = [("place-china", "P89_FALLS_WITHIN", "place-europe"), ("person-1", "P53_HAS_FORMER_OR_CURRENT_LOCATION", "place-asia"), ("site-3", "P4_HAS_TIME-SPAN", "person-2")]
    e = e.unionAll(t.spark.createDataFrame(extra, "src string, rel_type string, dst string"))
    names = X.nodes(t).select("entity_id", F.lit("name").alias("path"), F.col("name").alias("value"))
    kinds = t.spark.createDataFrame([("place-asia", "P2_has_type", "continent"), ("place-china", "P2_has_type", "region")], "entity_id string, path string, value string")
    odd = t.spark.createDataFrame([("chunk-1", "Chunk", "a chunk")], "entity_id string, label string, name string")
    return X.nodes(t).unionAll(odd), e, names.unionAll(kinds)


SHACL = f"""WITH {NODES}, {EDGES.replace("edges AS", "plain AS")}, edges AS (
  SELECT * FROM plain WHERE NOT (rel_type = 'P4_HAS_TIME-SPAN' AND src IN (SELECT 'event-' || o_orderkey FROM orders WHERE o_orderkey % 100 = 0))
  UNION ALL VALUES ('place-china', 'P89_FALLS_WITHIN', 'place-europe'), ('person-1', 'P53_HAS_FORMER_OR_CURRENT_LOCATION', 'place-asia'), ('site-3', 'P4_HAS_TIME-SPAN', 'person-2')
)
SELECT entity_id AS focus_id, label AS shape, 'P4_HAS_TIME-SPAN' AS path, 'minCount' AS "constraint", 'Violation' AS severity, '0' AS observed FROM nodes WHERE label = 'E5_Event' AND entity_id NOT IN (SELECT src FROM edges WHERE rel_type = 'P4_HAS_TIME-SPAN')
UNION ALL SELECT src, 'E53_Place', 'P89_FALLS_WITHIN', 'maxCount', 'Violation', CAST(count(*) AS VARCHAR) FROM edges WHERE rel_type = 'P89_FALLS_WITHIN' GROUP BY src HAVING count(*) > 1
UNION ALL SELECT src, 'E21_Person', rel_type, 'closed', 'Violation', dst FROM edges WHERE src LIKE 'person-%' AND rel_type = 'P53_HAS_FORMER_OR_CURRENT_LOCATION'
UNION ALL SELECT src, 'E27_Site', rel_type, 'class', 'Violation', 'E21_Person' FROM edges WHERE src LIKE 'site-%' AND dst LIKE 'person-%'
UNION ALL SELECT 'place-asia', 'E53_Place', 'P2_has_type', 'in', 'Violation', 'continent' FROM nodes WHERE entity_id = 'place-asia'
UNION ALL SELECT 'chunk-1', 'Chunk', 'label', 'undeclared', 'Warning', 'Chunk'"""


@query(SHACL)
def shacl_report(t: X.Tables) -> DataFrame:
    return G.violations(*_faulty(t))


def _one_constraint(name: str, constraint: str):
    def run(t: X.Tables) -> DataFrame:
        return G.violations(*_faulty(t), only=constraint).drop("constraint")

    run.__name__ = name
    return query(f"SELECT focus_id, shape, path, severity, observed FROM ({SHACL}) WHERE \"constraint\" = '{constraint}'")(run)


for _name, _constraint in (("shacl_min_count", "minCount"), ("shacl_max_count", "maxCount"), ("shacl_class", "class"), ("shacl_in", "in"), ("shacl_closed", "closed"), ("shacl_undeclared", "undeclared")):
    _one_constraint(_name, _constraint)


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_counts(t: X.Tables) -> DataFrame:
    return I.event_counts(t.events)
