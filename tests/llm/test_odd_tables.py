"""Every operator on odd tables: nulls, empty and long texts, ties, repeated rows, clashing columns, no rows."""

import hashlib
import zlib

import pytest

from lorekeep.llm import decontam, lm, media, mixing, near_dup, quality, secrets, suffix_dedup, tokens, urls

LONG = " ".join(f"word{i % 997} and{i % 13}" for i in range(30_000))
SHARED = " ".join(f"shared{i}" for i in range(60))
CLASHING = ("size", "rep", "body", "component_id", "n", "v", "at", "bucket", "_id", "_row", "position")
TEXTS = [
    (1, None, "a"),
    (2, "", "a"),
    (3, "one", None),
    (None, "a text without an id " + SHARED, "b"),
    (5, SHARED + " five", "b"),
    (6, SHARED + " five", "b"),
    (6, SHARED + " five", "b"),
    (7, LONG, "c"),
    (8, "tab\tand\x0bother \u00e9\u4e2d\U0001f600 spaces\n\n  x", None),
    (9, " \n ", ""),
]
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, "en", len(t or ""), *["x"] * len(CLASHING)) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, TEXTS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (7, 0, 0), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, SHARED), (2, None), (None, "one"), (3, "")], "item_id long, text string")


def test_suffix_dedup(odd, none):
    rows = suffix_dedup.without_repeats(odd).collect()
    assert len(rows) == len(TEXTS)
    by = {r.doc_id: r for r in rows}
    assert by[1].n_bytes == 0 and by[1].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[6].n_removed == len(SHARED + " five") and by[6].n_spans == 1
    assert by[None].n_removed > 0
    assert suffix_dedup.without_repeats(none).collect() == []


def test_secrets(odd, none):
    assert secrets.findings(odd).where("secret").count() == 0
    assert secrets.findings(none).collect() == []


def test_media(odd, none):
    rows = media.described(media.stored(odd)).collect()
    want = sorted((len((t or "").encode()), hashlib.sha256((t or "").encode() + bytes(-len((t or "").encode()) % 64 if t else 64)).hexdigest()) for _, t, _ in TEXTS)
    assert sorted((r.n_bytes, r.payload_sha256) for r in rows) == want
    assert media.described(media.stored(none)).collect() == []


def test_lm(odd, none):
    rows = lm.scored(odd).collect()
    assert len(rows) == len(TEXTS)
    assert all(r.score < 0 and r.base_score < 0 for r in rows)
    assert next(r for r in rows if r.doc_id is None).held_out
    empty = [r for r in rows if r.doc_id in (1, 2)]
    assert {r.n_tokens for r in empty} == {1} and len({r.score for r in empty}) == 1
    assert lm.scored(none).collect() == []


def test_mixing(odd, none):
    rows = mixing.in_training_order(mixing.plan(odd)).collect()
    assert len(rows) == len(TEXTS)
    sizes, taken = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(taken[r.source] - r.target) < 1
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.plan(none).collect() == [] and mixing.mixed(none).collect() == []


def test_tokens(odd, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.tokenizer_path())
    rows = sorted(tokens.token_output(odd).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((i for i, _, _ in TEXTS), key=lambda i: (i is not None, i))
    start = 0
    for r in rows:
        text = next(x for i, x, _ in TEXTS if i == r.doc_id)
        ids = b"".join(i.to_bytes(4, "little") for i in [*t.encode(text or "", add_special_tokens=False).ids, 2])
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids) // 4, zlib.crc32(ids))
        start += r.n_tokens
    assert tokens.token_output(none).collect() == []


def test_added_tokens(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.tokenizer_path())
    e = "<|endoftext|>"
    texts = [f"a {e} b", e, f"{e}{e}", f"x\n\n {e}\n  y {e[:-1]} <|{e}|>", f"don't{e}'s  {e}   ", "plain text", f"\u00e9{e}\u4e2d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in tokens.token_output(docs).collect()}
    start = 0
    for i, text in enumerate(texts):
        ids = [*t.encode(text, add_special_tokens=False).ids, 2]
        crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), crc), text
        start += len(ids)


def test_urls(spark, labels):
    schema = "page_id long, url string, html string, host string, path string"
    given = [(1, None), (2, "no scheme"), (3, "http://X.Example.ORG/es/1"), (3, "http://X.Example.ORG/es/1"), (None, "http://a.org"), (5, "http://a.org/"), (6, "x://h?q#f"), (7, "no-scheme?q=1")]
    pages = spark.createDataFrame([(i, u, "", "clash", "clash") for i, u in given], schema)
    rows = sorted((r.host, r.path, r.rule, r.verdict) for r in urls.verdicts(pages, labels).where("page_id is not null").fillna("-").collect())
    assert rows == sorted([*[("", "", "-", "allow")] * 3, ("x.example.org", "/es/1", "example.org/es/", "block"), ("x.example.org", "/es/1", "example.org/es/", "block"), ("a.org", "/", "org/", "allow"), ("h", "", "-", "allow")])
    assert urls.verdicts(pages, labels.limit(0)).count() == len(given)
    assert urls.verdicts(pages.limit(0), labels).collect() == []


def test_quality(odd, none, labels):
    model = quality.fit(odd, labels)
    rows = quality.score(odd, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert next(r for r in rows if r.doc_id is None).held_out
    assert quality.accepted(odd, model).columns == odd.columns
    blank = quality.fit(odd, labels.limit(0))
    assert {r.score for r in quality.score(odd, blank).collect()} == {0.5}
    assert quality.score(none, model).collect() == []


def test_decontam(odd, none, items):
    rows = decontam.contamination(odd, items).collect()
    assert len(rows) == len(TEXTS)
    by = {r.doc_id: r for r in rows}
    assert by[5].n_hit == 60 and by[5].n_items == 1 and by[5].contaminated
    assert by[3].n_hit == 1 and by[3].contaminated
    assert by[1].n_words == 0 and not by[1].contaminated
    kept = decontam.uncontaminated(odd, items)
    assert kept.columns == odd.columns and kept.count() == len(TEXTS) - 5
    assert decontam.contamination(odd, items.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.contamination(none, items).collect() == []


def test_decontam_in_blocks(spark, odd, none, items):
    more = odd.unionByName(table(spark, [(None, "clean text without an id", "b"), (5, "clean text of an equal id", "b")]))
    key = lambda d: sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in d.collect())
    whole, parts = decontam.uncontaminated(more, items), decontam.uncontaminated(more, items, limit=64)
    assert len(list(decontam.benchmark_blocks(items, 64))) > 1
    assert parts.columns == more.columns and key(parts) == key(whole)
    assert parts.count() == len(TEXTS) - 5 + 2
    assert sorted(map(str, decontam.contamination(more, items, limit=64).collect())) == sorted(map(str, decontam.contamination(more, items).collect()))
    assert decontam.uncontaminated(none, items, limit=64).collect() == []


def test_near_dup(odd, none):
    rows = near_dup.near_duplicates(odd).collect()
    assert len(rows) == len(TEXTS)
    by = {r.doc_id: r for r in rows}
    assert by[None].component_id is None and by[None].kept
    assert (by[6].component_id, by[6].kept) == (5, False)
    assert by[1].n_shingles == 0 and by[1].kept and by[1].component_id == 1
    kept = near_dup.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 5, 7, 8, 9]
    assert near_dup.near_duplicates(none).collect() == []
