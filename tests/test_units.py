"""Golden vectors, independent versions and properties of the library's operators."""

import json
import math
import re
import time
from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lorekeep import constants as K
from lorekeep.functions import text as T
from lorekeep.functions import vectors as V
from lorekeep.functions.similarity import may_reach
from lorekeep.operators import extraction as E
from lorekeep.operators import graph as G
from lorekeep.operators import resolution as R
from lorekeep.operators import segments as S
from lorekeep.plans import retrieval as P
from lorekeep.sources import tables as D
from lorekeep.streaming import incremental as I


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first().x


# ---- names and text -----------------------------------------------------------------------------


def test_names(spark):
    name = "  The  Cactus   Hill "
    assert one(spark, T.normalized(F.col("n")), n=name) == "cactus hill"
    assert one(spark, T.entity_id(F.lit(K.SITE), F.col("n")), n=name) == "site-the-cactus-hill"
    assert one(spark, T.entity_id(F.lit("Odd"), F.col("n")), n="X") == "odd-x"
    assert one(spark, T.slug(F.col("n")), n="中") == ""
    assert [one(spark, T.canonical_type(F.lit(s))) for s in ("Site", "Archaeological Site", "E27_Site", "Thing")] == [K.SITE] * 3 + [None]
    assert one(spark, T.clamp(F.lit(float("nan")))) == 1.0
    assert one(spark, T.clamp(F.lit(None).cast("double"))) is None


@pytest.mark.parametrize("given_,want", [("a\n32 INDIAN WARS.\nb", "a\nb\n"), ("v/ater vvise", "water wise\n"), ("x  \n", "x\n"), ("hap\\-py dayy", "happy day\n")])
def test_clean(spark, given_, want):
    assert one(spark, T.clean(F.col("t")), t=given_) == want


def test_page_number_rule(spark):
    assert one(spark, T.rule("page_number", F.col("t")), t="a\n12.\n\n\nb\n") == "a\n\nb\n"


def test_image_block(spark):
    block = "\n![Image 1 (page 2)](embedded:x)" * 51
    assert one(spark, T.cut_images(F.col("t")), t="text \n" + block) == "text\n"
    assert one(spark, T.cut_images(F.col("t")), t=block) == block
    few = "text" + "\n![Image 1 (page 2)](embedded:x)" * 50
    assert one(spark, T.cut_images(F.col("t")), t=few) == few


def test_cosine(spark):
    a, b = F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(2.0))
    assert one(spark, V.cosine(a, b)) == 0 and one(spark, V.cosine(a, a)) == 1 and one(spark, V.cosine(a, b, "unit")) == 0.5
    assert one(spark, V.cosine(a, F.array(F.lit(0.0), F.lit(0.0)))) is None


# ---- segments ---------------------------------------------------------------------------------------


def page(n, body):
    return f"<!-- PAGE {n} -->\n{body}\n"


def test_page_sections():
    text = "pre" + page(1, "a" * 400) + page(2, "b" * 400) + page(3, "c" * 4500) + page(4, "d" * 3000 + "\n\n" + "e" * 3000) + page(5, "f" * 300)
    got = S.page_sections(text)
    assert [(n, len(t)) for n, t in got] == [("page-1-2", 802), ("page-3", 4500), ("page-4_part0", 3000), ("page-4_part1", 3302)]
    assert S.page_sections("  x ") == [("page-1", "x")] and S.page_sections("") == [("page-1", "")]
    assert S.page_sections("<!-- page 3 -->  ") == [("page-1", "<!-- page 3 -->")]


def test_sections_a_few_texts_at_a_time(spark, monkeypatch):
    texts = [(f"d{i}", "".join(f"<!-- PAGE {p} -->\n\n{'x' * (400 * i)}\n\n" for p in range(1, 5)) if i != 2 else None) for i in range(6)] + [(None, "")]
    docs = spark.createDataFrame(texts, "doc_name string, text string").coalesce(1)
    want = sorted(((n, i, a, b) for n, t in texts if t is not None for i, (a, b) in enumerate(S.page_sections(t))), key=str)
    assert "MapInArrow" in S.sections(docs)._jdf.queryExecution().executedPlan().toString()
    for rows, chars in ((64, 1 << 20), (2, 1 << 20), (64, 1000)):
        monkeypatch.setattr(S, "CUT_ROWS", rows)
        monkeypatch.setattr(S, "CUT_CHARS", chars)
        assert sorted(map(tuple, S.sections(docs).collect()), key=str) == want


def test_packed():
    got = S.packed(["a" * 15, "b" * 18, "cc"], 20, 5)
    assert [len(c) for c in got] == [15, 25, 9] and got[1] == "aaaaa\n\n" + "b" * 18
    assert S.packed(["Aaa bbb. Ccc ddd. Eee fff.", "gg"], 20, 4) == ["Aaa bbb.\n\nCcc ddd.", "ddd.\n\nEee fff.\n\ngg"]
    assert S.packed(["x" * 30], 20, 5) == ["x" * 30]


def test_sections_by_heading():
    assert S.by_heading("intro\n## A\nbody\n### B\n# C\nmore") == [("", "intro"), ("A", "body"), ("B", "# C\nmore")]
    assert S.without_tiny([("", "x"), ("A", "y" * 200), ("B", "")]) == [("A", "x\n\n" + "y" * 200 + "\n\n## B")]
    assert [n for n, _ in S.relation_sections("## One\n" + "a" * 2900 + "\n## Two Three\n" + "b" * 3100)] == ["sec-000-one", "sec-001-two-three"]
    assert [n for n, _ in S.heading_sections("x\n# T\n" + "a" * 1200)] == ["preamble"]
    assert S.chunks("## " + "h" * 2000) == []


@given(st.lists(st.text("ab \n", max_size=60), max_size=30), st.integers(2, 8))
def test_pieces_keep_all_text(pieces, target):
    joined = "\n\n".join(pieces)
    parts = S.in_parts(joined, "s", target * 10)
    assert "".join(t for _, t in parts).replace("\n", "") == joined.replace("\n", "")


def test_windows(spark):
    docs = spark.createDataFrame([(f"d{n}", "\n".join(map(str, range(n)))) for n in (1, 94, 95, 96, 100, 101, 195, 290)], "doc_name string, text string")
    w = S.windows(docs)
    assert [(r.first, r.end) for r in w.where("doc_name = 'd101'").orderBy("window").collect()] == [(0, 100), (95, 101)]
    same = {r.doc_name: r.text for r in S.reassembled(w).collect()}
    assert same == {r.doc_name: r.text for r in docs.collect()}
    old = S.reassembled(w, compat=True).where("doc_name = 'd101'").first().text.split("\n")
    assert old == [str(i) for i in range(101) if not 95 <= i < 100]


def test_chunked(spark):
    docs = spark.createDataFrame([("d", "intro\n\n## A\n\n" + "Word one. " * 400), ("e", None), ("f", "")], "doc_name string, text string")
    rows = S.chunked(docs).orderBy("chunk_index").collect()
    assert [r.chunk_id for r in rows] == [f"d-{i:04d}" for i in range(len(rows))] and len(rows) > 1
    stats = S.chunk_stats(S.chunked(docs)).first()
    assert stats.n_chunks == len(rows) and stats.mean_chars == sum(len(r.text) for r in rows) // len(rows)


# ---- extraction ---------------------------------------------------------------------------------------


def test_parsing(spark):
    raws = [
        ("s1", '[{"name":" Hill ","type":"Site","aliases":["H"," "],"confidence":"0.5",},]'),
        ("s2", '{"name":"A","type":"Person"}'),
        ("s3", "no json"),
        ("s4", 'Sure: [{"name":"B","type":"Group","confidence":7}] ok'),
        ("s5", '[{"name":"x, ]","aliases":["p",],},]'),
    ]
    rows = {r.source_section: r for r in E.parsed_entities(spark.createDataFrame(raws, "section_id string, raw_json string")).collect()}
    assert (rows["s1"].name, rows["s1"].entity_type, rows["s1"].aliases, rows["s1"].confidence) == ("Hill", K.SITE, ["H"], 0.5)
    assert rows["s2"].confidence == 1.0 and rows["s3"].status == "unparsable" and rows["s4"].confidence == 1.0
    assert (rows["s5"].name, rows["s5"].status) == ("x]", "unknown type")
    assert one(spark, E.unfenced(F.col("r")), r="```json\n[1]\n```") == "[1]"
    assert one(spark, E.prefilled(F.col("r")), r="1]") == "[1]"


def test_validation_order(spark):
    names = spark.createDataFrame([("Ann",), ("Hill",), ("HILL",)], "name string")
    rel = "head_name string, head_type string, relation_type string, tail_name string, tail_type string, confidence double"
    given_ = [
        ("Hill", K.SITE, "P45_CONSISTS_OF", "clay", "", 0.9), ("ann", K.PERSON, "P107I_IS_CURRENT_OR_FORMER_MEMBER_OF", "hill", K.GROUP, 0.9), ("Hill", K.ARTIFACT, "P45_CONSISTS_OF", "clay", "", 0.9),
        ("Zed", K.ARTIFACT, "P45_CONSISTS_OF", "clay", "", 0.9), ("Ann", K.PERSON, "MENTIONS", "Hill", K.GROUP, 0.9), ("", "", "", "", "", None),
    ]
    rows = [(r.head_name, r.tail_name, r.reject_reason) for r in E.validated(spark.createDataFrame(given_, rel), names).collect()]
    assert sorted(rows, key=str) == sorted([("Hill", "clay", "head type"), ("Ann", "HILL", None), ("Hill", "clay", None), ("Zed", "clay", "head unknown"), ("Ann", "Hill", "relation type"), ("", "", "unparsable")], key=str)


def test_model_slot(spark):
    def call(text):
        if text == "bad":
            raise RuntimeError("no")
        return text.upper()

    rows = {r.t: (r.raw_json, r.error) for r in E.with_model(spark.createDataFrame([("a",), ("bad",)], "t string"), call, ["t"]).collect()}
    assert rows == {"a": ("A", None), "bad": (None, "RuntimeError: no")}
    vec = E.embedded(spark.createDataFrame([("a",), ("bb",)], "t string"), lambda ts: [[float(len(t))] for t in ts], F.col("t")).collect()
    assert sorted(r.embedding for r in vec) == [[1.0], [2.0]]


def test_prompt_parts(spark):
    assert E.constraint_text().splitlines()[:3] == ["  P53_HAS_FORMER_OR_CURRENT_LOCATION  (located in)", "    Source types: E27_Site, E74_Group, E22_Man-Made_Object", "    Target types: E53_Place, E27_Site"]
    assert "(free text value)" in E.constraint_text() and "MENTIONS" not in E.constraint_text()
    assert one(spark, E.names_text(F.array(F.lit("b"), F.lit("a")))) == "  - a\n  - b"


# ---- resolution ------------------------------------------------------------------------------------------

FIELDS = "seq long, doc_name string, name string, entity_type string, aliases array<string>, description string"


def test_resolve(spark):
    e = [(1, "a", "The Powhatan", K.GROUP, ["Powhatan Confederacy"], "A confederacy. Large."), (2, "b", "powhatan", K.GROUP, [], "A confederacy. Tidewater."), (3, "b", "Powhattan Confederacy", K.GROUP, [], "")]
    got, flags = R.resolve(spark.createDataFrame(e, FIELDS))
    r = got.first()
    assert (r.name, r.aliases, r.entity_id) == ("Powhattan Confederacy", ["The Powhatan", "Powhatan Confederacy", "powhatan"], "group-powhattan-confederacy")
    assert (r.description, r.sources) == ("A confederacy. Large. Tidewater.", ["a", "b"]) and flags.count() == 0
    got, flags = R.resolve(spark.createDataFrame([(1, "a", "red widget", K.ARTIFACT, [], ""), (2, "a", "red gadget", K.ARTIFACT, [], "")], FIELDS))
    assert got.count() == 2 and [tuple(f) for f in flags.select("entity_a", "entity_b", "similarity").collect()] == [("red widget", "red gadget", 0.8)]


def test_bridge_does_not_join(spark):
    e = [(1, "d", "A1", K.SITE, [], ""), (2, "d", "B1", K.SITE, [], ""), (3, "d", "A1", K.SITE, ["B1"], ""), (4, "d", "B1", K.SITE, [], "")]
    assert {r.seq: r.cluster for r in R.exact_clusters(spark.createDataFrame(e, FIELDS)).collect()} == {1: 1, 2: 2, 3: 1, 4: 1}


def plain_resolution(names):
    """Greedy merging of distinct names, one after the other, by the written rule."""
    norm = lambda n: re.sub(r"\s+", " ", re.sub(r"^(the|a|an)\s+", "", n.strip().lower())).strip()
    gone, home, flags = set(), {}, set()
    for i, a in enumerate(names):
        if i in gone:
            continue
        for j in range(i + 1, len(names)):
            if j not in gone:
                r = SequenceMatcher(None, norm(a), norm(names[j])).ratio()
                if r >= 0.85:
                    gone.add(j)
                    home[j] = i
                elif r >= 0.75:
                    flags.add((i, j))
    return home, flags


def test_merging_against_plain_version(spark, sf):
    names = sorted({r.p_name for r in spark.read.parquet(f"{sf}/part.parquet").select("p_name").collect()})
    n = spark.createDataFrame([(i, x, K.ARTIFACT) for i, x in enumerate(names)], "seq long, name string, entity_type string")
    rows = R.merged_clusters(R.similar_names(n)).collect()
    home, flags = plain_resolution(names)
    assert {r.seq: r.into for r in rows if r.into is not None} == home
    assert {(r.seq, r.flagged_with) for r in rows if r.flagged_with is not None} == flags


def parts_in_order(spark, sf):
    """The part rows by key, the distinct names as they first appear, and what the plain version makes of them."""
    parts = sorted(spark.read.parquet(f"{sf}/part.parquet").collect(), key=lambda r: r.p_partkey)
    names = list(dict.fromkeys(r.p_name for r in parts))
    return parts, names, *plain_resolution(names)


def test_resolve_fuzzy_query(spark, sf):
    from lorekeep import catalog

    parts, names, home, _ = parts_in_order(spark, sf)
    want = set()
    for i, first in enumerate(names):
        if i not in home:
            variants = [first, *(names[j] for j in sorted(home) if home[j] == i)]
            own = [r for v in variants for r in parts if r.p_name == v]
            name = min(variants, key=lambda n: (-len(n), n))
            aliases, notes = (v for v in variants if v != name), dict.fromkeys(r.p_type for r in own)
            want.add((name, "|".join(aliases), " ".join(notes), "|".join(sorted({r.p_brand for r in own})), own[0].p_partkey))
    got = [(r.name, r.aliases, r.description, r.sources, r.seq) for r in catalog.QUERIES["resolve_fuzzy"](spark, sf).collect()]
    assert len(got) == len(want) and set(got) == want


def test_ambiguous_pairs_query(spark, sf):
    from lorekeep import catalog

    _, names, home, flags = parts_in_order(spark, sf)
    want = {(names[i], names[j], K.ARTIFACT, round(SequenceMatcher(None, names[i], names[j]).ratio(), 3)) for i, j in flags}
    got = [tuple(r) for r in catalog.QUERIES["ambiguous_pairs"](spark, sf).collect()]
    assert want and len(got) == len(want) and set(got) == want


def test_similar_names_of_odd_names(spark):
    names = ["", "the ", "aaaaaaaaaa", "aaaaaaaaaaaaa", "aaaab", "0123456789", "0123456798", "\U0001f600\U0001f600x", "\U0001f600\U0001f600y", "ééé zzz", "ééé zz", "x", "qqq zzz", "11 12 21", "1 11 221", "a.b*c", "a.b*d", "İstanbul", "istanbul"]
    got = R.similar_names(spark.createDataFrame([(i, n, K.SITE) for i, n in enumerate(names)], "seq long, name string, entity_type string"))
    keys = [r.k for r in spark.createDataFrame([(n,) for n in names], "n string").select(T.normalized(F.col("n")).alias("k")).collect()]
    ratio = {(i, j): SequenceMatcher(None, keys[i], keys[j]).ratio() for j in range(len(names)) for i in range(j)}
    assert {(r.seq_a, r.seq_b): r.similarity for r in got.collect()} == {p: x for p, x in ratio.items() if x >= K.FLAG_AT}


@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
def test_length_bound_is_safe(a, b):
    reach = 2 * min(len(a), len(b)) >= 0.75 * (len(a) + len(b))
    assert reach or SequenceMatcher(None, a, b).ratio() < 0.75
    assert may_reach is not None


def test_alias_map(spark):
    rows = [("e1", "Powhatan", ["Pow", "x"], 1), ("e2", "Pow", ["x"], 2)]
    for order in (rows, [r[:3] + (3 - r[3],) for r in rows]):
        got = {r.alias: r.entity_id for r in R.alias_map(spark.createDataFrame(order, "entity_id string, name string, aliases array<string>, seq long")).collect()}
        assert got["pow"] == "e2" and got["powhatan"] == "e1" and got["x"] == min(order, key=lambda r: r[3])[0]


# ---- graph and retrieval --------------------------------------------------------------------------------------


def frames(spark):
    nodes = spark.createDataFrame([("a", K.SITE, "A"), ("m", K.PLACE, "M"), ("b", K.PLACE, "B"), ("z", K.PERSON, "Z")], "entity_id string, label string, name string")
    edges = spark.createDataFrame([("a", "P53_HAS_FORMER_OR_CURRENT_LOCATION", "m"), ("m", "P89_FALLS_WITHIN", "b")], "src string, rel_type string, dst string")
    return nodes, edges


def ids(spark, *x):
    return spark.createDataFrame([(i,) for i in x], "entity_id string")


def status(spark, nodes, edges, *x):
    paths = G.shortest_paths(nodes, edges, ids(spark, *x))
    return P.connection_status(P.connection_lines(paths, nodes), len(x)).first().status


def test_paths(spark):
    nodes, edges = frames(spark)
    assert status(spark, nodes, edges, "a") == P.ONE_ENTITY
    assert status(spark, nodes, edges, "q", "r") == P.NO_PAIRS
    assert status(spark, nodes, edges, "a", "b") == "A -> B: connected in 2 hop(s) via [located in -> within]"
    assert status(spark, nodes, edges, "a", "z") == "No connection found between A and Z (within 3 hops)"


def test_merge(spark):
    g = spark.createDataFrame([("c1", "t", "s", 2, ["x"]), ("c2", "t", "s", 1, ["x"])], "chunk_id string, text string, source string, entity_count long, mentioned_entities array<string>")
    v = spark.createDataFrame([("c2", "t", "s", 0.9), ("c3", "t", "s", 0.95)], "chunk_id string, text string, source string, score double")
    got = [(r.chunk_id, round(r.score, 9), r.origin) for r in P.merged_chunks(g, v).collect()]
    assert got == [("c2", 1.7, "both"), ("c1", 1.0, "graph"), ("c3", 0.95, "vector")]


def test_mentions(spark):
    chunks = spark.createDataFrame([("1", "In Jamestown, James met Étude."), ("2", "St.x and St. y"), ("3", None)], "chunk_id string, text string")
    aliases = spark.createDataFrame([("james", "j"), ("tude", "t"), ("étude", "e"), ("st.", "s"), ("in", "i"), ("met étude", "m"), ("(x", "odd")], "alias string, entity_id string")
    plain = {(c, e) for c, t in (("1", "In Jamestown, James met Étude."), ("2", "St.x and St. y")) for a, e in [tuple(r) for r in aliases.collect()] if len(a) > 2 and re.search(r"\b" + re.escape(a) + r"\b", t, re.I)}
    assert {tuple(r) for r in G.mentions(chunks, aliases).collect()} == plain


def test_loading(spark):
    e = spark.createDataFrame([("p1", "Ann", K.PERSON, [], "", 1), ("p2", "ANN", K.PERSON, [], "", 2), ("p2", "Ann B", K.PERSON, [], "n", 3)], "entity_id string, name string, entity_type string, aliases array<string>, description string, seq long")
    r = spark.createDataFrame([("ann", "P11_HAD_PARTICIPANT", "ann", 0.5, "s1", 1), ("Ann", "P11_HAD_PARTICIPANT", "Ann", 0.7, "s2", 2), ("Ann", "P45_CONSISTS_OF", "clay", 0.9, "s", 3), ("Ann", "P45_CONSISTS_OF", "bone", 0.9, "s", 4), ("who", "P45_CONSISTS_OF", "x", 1.0, "s", 5)], "head_name string, relation_type string, tail_name string, confidence double, source_section string, seq long")
    linked = G.resolved(r, e)
    assert [tuple(x) for x in G.edges(linked, [F.col("seq")]).collect()] == [("p2", "P11_HAD_PARTICIPANT", "p2", 0.7, "s2")]
    assert [tuple(x) for x in G.property_values(linked, [F.col("seq")]).collect()] == [("p2", "clay, bone", None)]
    assert tuple(G.load_counts(linked).first()) == (2, 2, 1)
    assert {x.entity_id: x.name for x in G.nodes(e).collect()} == {"p1": "Ann", "p2": "Ann B"}


def test_client(spark):
    nodes, edges = frames(spark)
    chunks = spark.createDataFrame([("c1", "one", "d"), ("c2", "two", "d")], "chunk_id string, text string, document_name string")
    mentions = spark.createDataFrame([("c1", "a"), ("c1", "b"), ("c2", "a")], "chunk_id string, entity_id string")
    vectors = spark.createDataFrame([("c1", [1.0, 0.0]), ("c2", [0.0, 1.0])], "chunk_id string, embedding array<float>")
    g = P.Graph(nodes, edges, chunks, mentions, vectors, embed=lambda q: [0.0, 1.0])
    assert g.query()["answer"] == P.NO_QUERY and g.query(question="  ")["stats"]["path"] == "none"
    a = g.query(["a", "b", "gone"])
    assert a["stats"] == {"retrieval_method": "graph_traversal", "path": "A", "entities_selected": 3, "triples_retrieved": 2, "chunks_retrieved": 2}
    assert a["sources"][0] == {"chunk_id": "c1", "source": "d", "mentioned_entities": ["A", "B"]}
    assert a["answer"].startswith("## User Query\n(No text query — browsing selected entities)\n\n## Selected Entities (2)\n\n### Entity: A (Archaeological Site)\nGraph connections:\n  - A — located in — M")
    b = g.query(question="q", k=1)
    assert [s["chunk_id"] for s in b["sources"]] == ["c2"] and "[1] Source: d (relevance: 1.000)\ntwo" in b["answer"]
    c = g.query(["a"], "q")
    assert [(s["chunk_id"], s["origin"]) for s in c["sources"]] == [("c2", "both"), ("c1", "both")] and c["stats"]["path"] == "C"
    with pytest.raises(ValueError):
        g.query(mode="naive")
    assert g.health() == {"status": "ok"} and g.entities().count() == len(K.CATEGORIES)


def test_shapes(spark):
    assert len(K.SHAPES) == 49
    nodes, edges = frames(spark)
    nodes = nodes.unionAll(spark.createDataFrame([("c", "Chunk", "C")], nodes.schema))
    names = nodes.select("entity_id", F.lit("name").alias("path"), F.col("name").alias("value")).where("entity_id <> 'z'")
    got = {(r.focus_id, r.path, r.constraint, r.severity) for r in G.violations(nodes, edges, names).collect()}
    assert got == {("z", "name", "minCount", "Violation"), ("c", "label", "undeclared", "Warning")}


def test_shapes_of_many_nodes(spark, monkeypatch):
    frame = lambda rows, names: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names.split()))
    nodes = frame([*((f"e{i}", K.EVENT, f"E{i}") for i in range(60)), ("p", K.PLACE, "P"), ("t", K.PERIOD, "T"), ("h", K.PERSON, "H"), ("s", K.SITE, "S")], "entity_id label name")
    edges = [*((f"e{i}", "P8_TOOK_PLACE_ON_OR_WITHIN", "p") for i in range(60)), *((f"e{i}", "P4_HAS_TIME-SPAN", "t") for i in range(1, 60)), ("e2", "P4_HAS_TIME-SPAN", "h")]
    edges += [("s", "P53_HAS_FORMER_OR_CURRENT_LOCATION", "nowhere"), ("s", "P70I_IS_DOCUMENTED_IN", None), ("h", "P8_TOOK_PLACE_ON_OR_WITHIN", "p"), ("unknown", "P8_TOOK_PLACE_ON_OR_WITHIN", "h")]
    literals = [(r.entity_id, "name", r.name) for r in nodes.collect()] + [("p", "P2_has_type", "moon"), ("p", "name", "Q")]
    event, place, site, span = K.EVENT, K.PLACE, K.SITE, "P4_HAS_TIME-SPAN"
    want = {("e0", event, span, "minCount", "0"), ("e2", event, span, "maxCount", "2"), ("e2", event, span, "class", K.PERSON), ("p", place, "name", "maxCount", "2"), ("p", place, "P2_has_type", "in", "moon")}
    want |= {("s", site, "P53_HAS_FORMER_OR_CURRENT_LOCATION", "class", "(missing)"), ("s", site, "P70I_IS_DOCUMENTED_IN", "class", "(missing)"), ("h", K.PERSON, "P8_TOOK_PLACE_ON_OR_WITHIN", "closed", "p")}
    for rows, suspects in ((250_000, 50_000), (10, 1)):
        monkeypatch.setattr(G, "PART_ROWS", rows)
        monkeypatch.setattr(G, "BROADCAST_SUSPECTS", suspects)
        report = G.violations(nodes, frame(edges, "src rel_type dst"), frame(literals, "entity_id path value"))
        got = [(r.focus_id, r.shape, r.path, r.constraint, r.observed) for r in report.collect()]
        assert set(got) == want and len(got) == len(want)
    for constraint in ("minCount", "maxCount", "class", "in", "closed", "undeclared"):
        some = G.violations(nodes, frame(edges, "src rel_type dst"), frame(literals, "entity_id path value"), only=constraint)
        assert {(r.focus_id, r.shape, r.path, r.constraint, r.observed) for r in some.collect()} == {w for w in want if w[3] == constraint}


# ---- files and streams -------------------------------------------------------------------------------------


def test_files(spark, tmp_path):
    (tmp_path / "b.md").write_text("B\n\ntext", encoding="utf-8")
    (tmp_path / "a.md").write_text("A", encoding="utf-8")
    docs = D.markdown(spark, str(tmp_path))
    assert [(r.doc_name, r.text) for r in docs.orderBy("doc_name").collect()] == [("a", "A"), ("b", "B\n\ntext")]
    (tmp_path / "x.pdf").write_bytes(b"one|two|")
    pages = D.pdf_pages(spark, str(tmp_path), lambda b: b.decode().split("|"))
    assert D.marked(pages).first().text == "<!-- PAGE 1 -->\n\none\n\n<!-- PAGE 2 -->\n\ntwo\n\n<!-- PAGE 3 -->\n\n"
    (tmp_path / "e.json").write_text(json.dumps([{"name": "N", "entity_type": K.SITE, "confidence": 3}]), encoding="utf-8")
    e = D.entity_files(spark, str(tmp_path / "e.json")).first()
    assert (e.doc_name, e.aliases, e.description, e.confidence) == ("e", [], "", 1.0)
    (tmp_path / "r.json").write_text(json.dumps({"count": 1, "relations": [{"head_name": "h", "relation_type": "t", "tail_name": "u", "confidence": 0.5}]}), encoding="utf-8")
    assert D.relation_files(spark, str(tmp_path / "r.json")).first().head_name == "h"
    (tmp_path / "g.json").write_text(json.dumps({"entity_count": 1, "entities": [{"entity_id": "i", "name": "n"}]}), encoding="utf-8")
    assert D.registry_files(spark, str(tmp_path / "g.json")).first().entity_id == "i"
    D.write_texts(docs, str(tmp_path / "out"))
    assert {p.parent.name: p.read_text() for p in (tmp_path / "out").rglob("part-*.txt")} == {"doc_name=a": "A\n", "doc_name=b": "B\n\ntext\n"}
    D.write_relations(D.relation_files(spark, str(tmp_path / "r.json")), str(tmp_path / "rels"), "m")
    assert spark.read.json(str(tmp_path / "rels")).first()["count"] == 1


def test_increments(spark, tmp_path):
    docs = spark.createDataFrame([("a",), ("b",)], "doc_name string")
    done = docs.limit(1)
    assert I.pending(docs, done).count() == 1 and I.pending(docs, done, force=True).count() == 2
    assert I.with_cached(docs.where("doc_name = 'b'"), docs).count() == 2
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("hello")
    run = lambda: I.appended(I.new_files(spark, str(tmp_path / "in")), lambda b: b.select(F.length("text").alias("n")), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    run()
    run()
    (tmp_path / "in" / "b.md").write_text("hi")
    run()
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [2, 5]


def test_event_counts_stream_equals_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.write.parquet(str(tmp_path / "ev"))
    stream = I.event_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "ev")))
    q = stream.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("counts").collect())) == sorted(map(tuple, I.event_counts(events).collect()))


def test_whole_documents_are_merged(spark, sf):
    from lorekeep import catalog

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    long = {r.doc_id for r in docs.where("length(text) >= 600").select("doc_id").collect()}
    rows = catalog.QUERIES["merge_descriptions"](spark, sf).collect()
    assert long & {r.doc_id for r in rows}
    longest = docs.orderBy(F.desc(F.length("text"))).first()
    own = {r.sentence.lower() for r in rows if r.source == longest.source}
    assert longest.text.split(". ")[-1].strip().lower() in own


def test_every_query_vector_is_searched(spark, sf):
    from lorekeep import catalog

    want = {r.vec_id for r in spark.read.parquet(f"{sf}/embeddings.parquet").where("vec_id % 50 = 0").collect()}
    rows = catalog.QUERIES["vector_topk_each"](spark, sf).collect()
    assert len(want) > 1 and {r.query_id for r in rows} == want and len(rows) == 10 * len(want)
    one = {(r.chunk_id, r.score) for r in catalog.QUERIES["vector_topk"](spark, sf).collect()}
    assert {(r.chunk_id, r.score) for r in rows if r.query_id == 0} == one


# ---- the build ------------------------------------------------------------------------------------------


def test_build(spark, tmp_path, capsys):
    from lorekeep import build as B

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("Ann lives on the Hill.\n\nThe Hill is old.", encoding="utf-8")
    (tmp_path / "in" / "b.md").write_text("   ", encoding="utf-8")
    (tmp_path / "in" / "bad.pdf").write_bytes(b"?")
    (tmp_path / "in" / "c.pdf").write_bytes(b"Ann again|")
    asked = tmp_path / "asked"

    def parse(content):
        if content == b"?":
            raise ValueError("no PDF")
        return content.decode().split("|")

    def entities(text):
        with open(asked, "a") as f:
            f.write("x")
        return json.dumps([{"name": "Ann", "type": "Person"}, {"name": "Hill", "type": "Site", "aliases": ["the Hill"]}] if "Hill" in text else [{"name": "ann", "type": "Person"}])

    def relations(text, constraints, names):
        assert "Source types" in constraints and "Ann" in names or "ann" in names
        return json.dumps([{"head_name": "Hill", "head_type": K.SITE, "relation_type": "P53_HAS_FORMER_OR_CURRENT_LOCATION", "tail_name": "hill", "tail_type": K.SITE, "confidence": 0.9}])

    models = B.Models(parse, entities, relations, lambda texts: [[float(len(t)), 1.0] for t in texts])
    b = B.Build(spark, str(tmp_path / "store"), models)
    counts = b.all(str(tmp_path / "in"))
    assert counts["nodes"] == 2 and counts["edges"] == 1 and counts["documents"] >= 2 and counts["mentions"] >= 3
    assert [tuple(r) for r in b.store.get("unreadable").collect()] == [("bad", "ValueError: no PDF")]
    assert {r.name for r in b.store.get("registry").collect()} == {"Ann", "Hill"} or {r.name for r in b.store.get("registry").collect()} == {"Ann", "the Hill"}
    calls = len(asked.read_text())
    again = b.all(str(tmp_path / "in"))
    assert again == counts and len(asked.read_text()) == calls  # cached answers
    assert b.store._versions("nodes") == [1, 2]  # the version before is kept
    assert {r.doc_name: r.n_entities for r in b.report().collect()} == {"a": 2, "c": 1}
    assert b.store.get("chunk_vectors").count() == counts["chunks"]
    with pytest.raises(ValueError):
        B.Build(spark, str(tmp_path / "empty")).ner()
    B.main(["chunk", "--store", str(tmp_path / "store")])
    assert "chunk: done" in capsys.readouterr().out


def test_pdf_without_pages(spark, tmp_path):
    from lorekeep.sources import tables as D

    (tmp_path / "none.pdf").write_bytes(b"")
    (tmp_path / "two.pdf").write_bytes(b"a|")
    pages = D.pdf_pages(spark, str(tmp_path), lambda c: c.decode().split("|") if c else [])
    assert sorted(map(tuple, pages.collect())) == [("two", 1, "a"), ("two", 2, "")]
    assert D.unreadable(spark, str(tmp_path), lambda c: []).collect() == []


def test_model_limits(spark):
    began = time.monotonic()
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "t string")

    def call(text):
        raise RuntimeError("busy")

    got = E.with_model(rows, call, ["t"], attempts=2, waits=lambda n, e: 0.05, per_minute=600, fallback="t").collect()
    assert sorted((r.raw_json, r.error) for r in got) == [(x, "RuntimeError: busy") for x in "abc"]
    assert time.monotonic() - began > 0.5  # six calls, a tenth of a second apart


def test_registry_and_tables(spark, tmp_path):
    e = spark.createDataFrame([("site-b", "B", K.SITE, ["x"], "", ["d"]), ("site-a", "A", K.SITE, [], "", ["d"])], "entity_id string, name string, entity_type string, aliases array<string>, description string, sources array<string>")
    none = spark.createDataFrame([], "entity_a string, entity_b string, entity_type string, similarity double")
    some = spark.createDataFrame([("A", "B", K.SITE, 0.8)], none.schema)
    for pairs, keys in ((none, {"entity_count", "entities"}), (some, {"entity_count", "entities", "ambiguous_candidates"})):
        D.write_registry(R.registry(e, pairs), str(tmp_path / "r"))
        (file,) = (tmp_path / "r").glob("part-*.json")
        got = json.loads(file.read_text())
        assert set(got) == keys and [x["entity_id"] for x in got["entities"]] == ["site-a", "site-b"] and got["entity_count"] == 2
    t = spark.createDataFrame([("d", 1, "T", ["h"], [["1"], ["2"], ["3"], ["4"]])], "doc_name string, page_num int, title string, headers array<string>, rows array<array<string>>")
    D.write_tables(t, str(tmp_path / "t"))
    assert E.table_preview(spark.read.json(str(tmp_path / "t"))).first().preview == [["1"], ["2"], ["3"]]
    (tmp_path / "x").mkdir()
    for n in "ba":
        (tmp_path / "x" / f"{n}.md").write_text(n)
    assert [r.doc_name for r in D.listing(spark, str(tmp_path / "x")).collect()] == ["a", "b"]
    assert D.column_crops(100, 200, 0.4) == ((0.0, 0.0, 40.0, 200), (40.0, 0.0, 100, 200))
    assert one(spark, E.page_base64(F.lit(b"abc"))) == "YWJj"


@given(st.lists(st.text("abx ", min_size=0, max_size=12), max_size=8), st.integers(0, 3))
@settings(max_examples=60, deadline=None)
def test_similar_names_all_found(names, _):
    """No pair at or over the threshold lacks a common rare character."""
    def rare(key):
        order = sorted(f"{(K_COMMON.find(c) + 1):02d}{c}{key[: i + 1].count(c)}" for i, c in enumerate(key))
        return set(order[: len(key) - math.ceil(len(key) * 0.75 / 1.25 - 1e-9) + 1]) if key else {""}

    K_COMMON = R.COMMON[::-1]
    for a in names:
        for b in names:
            if SequenceMatcher(None, a, b).ratio() >= 0.75:
                assert rare(a) & rare(b)


def test_components_by_rounds_and_in_one_task(spark):
    from lorekeep.operators import components as C

    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (5, 5)]
    d = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in C.components(d).collect()}
    assert got == {r.node: r.component for r in C.few_components(d).collect()} == {r.node: r.component for r in C.few_components(d, few=3).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[201] == 200


def test_longer_paths(spark):
    nodes = spark.createDataFrame([(f"n{i}", K.PLACE, f"N{i}") for i in range(8)], "entity_id string, label string, name string")
    edges = spark.createDataFrame([(f"n{i}", f"r{i % 3}", f"n{i + 1}") for i in range(7)] + [("n0", "z", "n2"), ("n0", "a", "n2")], "src string, rel_type string, dst string")
    for most in (1, 2, 3, 4, 5):
        got = {(r.from_id, r.to_id): (r.hops, r.rel_types) for r in G.shortest_paths(nodes, edges, ids(spark, "n0", "n2", "n4", "n6", "n7"), most).collect()}
        assert got["n0", "n2"] == (1, ["a"]) and got["n6", "n7"] == (1, ["r0"])
        assert got["n0", "n4"] == ((3, ["a", "r2", "r0"]) if most >= 3 else (-1, []))
        assert got["n0", "n6"] == ((5, ["a", "r2", "r0", "r1", "r2"]) if most >= 5 else (-1, []))


def test_index_recall(spark):
    from lorekeep import catalog

    big = "/root/testdata/sf0.01"
    exact = {(r.query_id, r.chunk_id) for r in catalog.QUERIES["vector_topk_each"](spark, big).collect()}
    found = {(r.query_id, r.chunk_id) for r in catalog.QUERIES["vector_topk_index"](spark, big).collect()}
    assert len(exact & found) >= 0.9 * len(exact)


def test_seed_chunks(spark):
    chunks = spark.createDataFrame([("c1", "no"), ("c2", "A Bone pipe"), ("c3", "bone")], "chunk_id string, text string")
    assert [r.chunk_id for r in P.chunks_with(chunks, "bone").collect()] == ["c2"]
