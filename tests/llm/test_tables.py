"""Manifest, lexical search and host verdicts: their SQL and brute force on odd tables with links, copies and ties."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from florametrics.llm import hosttrust, lexical, merkle, queries  # noqa: F401  (importing queries registers them)
from florametrics.llm.common import lowered
from florametrics.llm.registry import ORACLES, QUERIES
from tests.compare import connect, difference, duck_rows, spark_rows
from tests.llm.test_operators import sentence

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h string, bag string, grp string, pos string, m string"


def check(spark, folder, name):
    got = spark_rows(QUERIES[name](spark, str(folder)))
    assert difference(got, duck_rows(connect(str(folder)), ORACLES[name])) is None
    return got[1]


def held(row, name, columns):
    return row[columns.index(name)][1]


# op11


def odd_documents(odd):
    """Nulls in every column, repeated rows and ids, many languages, one of them with a single row."""
    rng = random.Random(2)
    rows = [(i, t, "en", "s", None if i % 2 else i) for i, t in odd]
    rows += [(100 + i, sentence(rng, i % 9), rng.choice([None, "de", "EN", "", "é", "zz", "=x"]), None, i) for i in range(150)]
    rows += [(None, "No id", "de", "s", 1), (None, None, None, None, None), (7, "Other Text", "en", "s", 5), (7, "Other Text", "en", "s", 5), (900, "A", "solo", "s", 1)]
    return rows


def write(spark, folder, docs, **tables):
    spark.createDataFrame([(*r, *["clash"] * 5) for r in docs], DOCS).coalesce(1).write.parquet(f"{folder}/raw")
    spark.read.parquet(f"{folder}/raw").toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"}).to_parquet(f"{folder}/documents.parquet")
    for name, (rows, kinds) in tables.items():
        spark.createDataFrame(rows, kinds).toPandas().to_parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest(spark, tmp_path, odd, levels, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    write(spark, tmp_path, odd_documents(odd))
    assert len(check(spark, tmp_path, "op11_merkle_manifest")) == len(odd_documents(odd))


def test_manifest_finds_only_changed_rows(documents):
    rows = [(i, f"Text {i}" if i % 2 else f"text {i}") for i in range(700)]
    docs = documents(rows)
    found = merkle.manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, lowered(F.col("text"))).collect()
    assert {r.doc_id for r in found if not r.verified} == {i for i, t in rows if zlib.crc32(str(i).encode()) % 3 == 0 and t != t.lower()}
    assert len({r.root for r in found}) == 1 and all(len(r.proof_sha256) == 64 for r in found)
    one = merkle.manifest(documents([(5, "only")]), F.lit(False), F.col("text")).collect()
    assert one[0].leaf == one[0].subroot == one[0].root == one[0].folded_root and one[0].proof_sha256 == hashlib.sha256(b"").hexdigest()
    assert merkle.manifest(documents([]), F.lit(False), F.col("text")).collect() == []


@pytest.mark.parametrize("levels", range(1, 6))
def test_van_emde_boas_addresses(levels):
    places = np.concatenate([merkle.address(levels, d, np.arange(8 ** d)) for d in range(levels)])
    assert sorted(places) == list(range(merkle.size(levels)))
    if levels > 1:
        # The upper half comes first; every subtree below it lies in one piece.
        top = levels // 2
        low = merkle.size(levels - top)
        assert max(merkle.address(levels, top - 1, np.arange(8 ** (top - 1)))) < merkle.size(top)
        for d in range(top, levels):
            own = (merkle.address(levels, d, np.arange(8 ** d)) - merkle.size(top)) // low
            assert (own == np.arange(8 ** d) // 8 ** (d - top)).all()


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 4095, 4096])
def test_subtree_paths_fold_to_its_root(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    tree = merkle.Subtree(merkle.height(n), n)
    tree.build(leaves)
    level = [d.hex() for d in leaves]
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[i:i + 8]).encode()).hexdigest() for i in range(0, len(level), 8)]
    assert tree.texts(0) == level
    assert {merkle.fold(d.hex(), p) for d, p in zip(leaves, tree.paths())} == set(level)


# op12


def search_tables(odd):
    rng = random.Random(8)
    base = [sentence(rng, rng.randint(1, 60)) for _ in range(60)]
    docs = [(i, t, "en", "s", 1) for i, t in odd]
    docs += [(1000 + i, rng.choice(base) + rng.choice(["", " zzz", " !", " QQQ"]), "en", "s", 1) for i in range(400)]
    docs += [(2000 - i, "Ban bast,bar\tÉ é one_one", None, None, None) for i in range(300)] + [(1000, "fin fin one", "en", "s", 1), (None, base[0], "en", "s", 1)]
    items = [(i, " ".join(rng.choice(base).split()[:20]) + " one é") for i in range(30)]
    items += [(30, None), (31, ""), (32, "?!"), (33, "unseen only"), (34, "ban ban"), (34, "one"), (None, "one"), (35, items[0][1])]
    return docs, items


@pytest.mark.parametrize("limits", [{}, {"POSTINGS": 40}, {"CELLS": 200, "PAIRS": 300}])
def test_search(spark, tmp_path, odd, limits, monkeypatch):
    for name, value in limits.items():
        monkeypatch.setattr(lexical, name, value)
    docs, items = search_tables(odd)
    write(spark, tmp_path, docs, benchmark=(items, "item_id long, text string"))
    rows = check(spark, tmp_path, "op12_lexical_search")
    assert len({held(r, "item_id", ["doc_id", "item_id", "rank", "score"]) for r in rows}) == 32


def test_search_scores_a_class_once(spark, documents, monkeypatch):
    """Five hundred copies under other words outside the vocabulary reach the scorer as one bag."""
    bags = []
    own = lexical._score_task

    def counting(shared, k):
        bags.append(1)
        return own(shared, k)
    monkeypatch.setattr(lexical, "_score_task", counting)
    kept = {}
    monkeypatch.setattr(lexical, "saved", lambda df, name, save=lexical.saved: kept.setdefault(name, save(df, name)))
    docs = documents([(i, f"alpha beta x{i}") for i in range(500)] + [(900, "alpha other")])
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    found = lexical.search(docs, items).collect()
    assert [(r.rank, r.doc_id) for r in sorted(found)] == [(i + 1, i) for i in range(10)]
    assert kept["classes"].count() == 2 and len(bags) == 1


def test_search_of_nothing(spark, documents):
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert lexical.search(documents([]), items).collect() == []
    assert lexical.search(documents([(1, "alpha")]), items.limit(0)).collect() == []
    assert lexical.search(documents([(1, "alpha"), (2, "alpha")]), items).columns == ["item_id", "rank", "doc_id", "score"]


# op13


def page(*links, extra=""):
    return "<p>x</p>" + "".join(f'<a class="k" href="{x}">y</a>' for x in links) + extra


#: Blocked: the spam ring's hub and, over reversed links, who links to it; the allowed side reaches what good hosts link to.
PAGES = [
    (1, "http://good.org/a", page("http://friend.net/1", "//friend.net/2", "/own", "http://GOOD.org/self", "https://both.net/")),
    (2, "https://a.b.org/x?q#f", page("http://friend.net", extra='<!-- <a href="http://hidden.net/">h</a> --><script>"<a href=http://script.net/>"</script>')),
    (3, "http://spam.com/de/1", page("http://spam.com/de/2")),
    (4, "http://spam.com/en/1", page("http://both.net/z")),
    (5, "http://ring1.net/1", page("http://spam.com/x")),
    (6, "http://ring2.net/1", page("http://ring1.net/") * 3),
    (7, "http://friend.net/q", None),
    (8, "http://both.net/q", page("http://spam.com/y", "http://spam.com:80/", "http://friend.net/")),
    (9, "http://example.org/es/3", page(extra="<A HREF=http://Target.NET>t</A><a\nhref='ftp://f.net/'>")),
    (10, "http://www.example.org/en/12", ""),
    (11, "http://example.org/en/2", "<style>unclosed <a href='//style.net/'>"),
    (12, None, page("http://spam.com/")), (13, "no scheme", page("http://spam.com/")), (14, "http://org", "x"), (15, "x://COM/fr/?", None),
    (16, "http://notorg/", None), (17, "http://target.net/de/", None), (None, "http://ring2.net/2", None), (18, "http://ring2.net/2", None),
    (18, "http://ring2.net/2", None), (19, "http://a\nb.org/c", None), (20, "", None), (21, "http://x.example.org:8080/es/", None),
    (22, "http://lone.net/" + "a" * 70_000, "<a " * 30_000 + "<!--" * 30_000),
]


def test_host_verdicts(spark, tmp_path):
    spark.createDataFrame([(*p, "c", "c", "c") for p in PAGES], "page_id long, url string, html string, host string, mass string, side string").toPandas().astype(
        {"page_id": "Int64"}).to_parquet(f"{tmp_path}/pages.parquet")
    check(spark, tmp_path, "op13_url_filters")
    found = {r.page_id: r for r in QUERIES["op13_url_filters"](spark, str(tmp_path)).collect()}
    verdict = {i: r.verdict for i, r in found.items()}
    assert {i for i, v in verdict.items() if v == "block"} == {3, 4, 5, 6, 9, 10, None, 18}
    assert found[9].rule == "example.org/es/" and found[10].rule == "example.org/en/1" and found[11].rule == "org/" and found[14].rule is None
    assert found[4].rule is None and found[7].trust > 0 and found[17].distrust == 0 < found[8].distrust
    assert (found[12].host, found[12].path, found[13].host, found[2].path, found[15].host) == ("", "", "", "/x", "com")


def brute_spread(seeds, links, rounds, damping):
    total = dict(seeds)
    for side in (0, 1):
        arcs = [(s, t, w) if side == 0 else (t, s, w) for s, t, w in links]
        front = {h: m for (x, h), m in seeds.items() if x == side}
        for _ in range(rounds):
            after = {}
            for s, t, w in arcs:
                if s in front:
                    after[t] = after.get(t, 0) + front[s] * w * damping // (100 * sum(b for a, _, b in arcs if a == s))
            front = after
            for h, m in front.items():
                total[side, h] = total.get((side, h), 0) + m
    return {k: v for k, v in total.items() if v}


def test_spread(spark):
    rng = random.Random(4)
    hosts = [f"h{i}" for i in range(25)]
    links = [(s, t, rng.randint(1, 5)) for s in hosts for t in hosts if s != t and rng.random() < 0.1] + [("hub", h, 1) for h in hosts]
    seeds = {(rng.randint(0, 1), h): rng.randint(1, 9) * hosttrust.UNIT for h in rng.sample(hosts, 8)}
    got = hosttrust.spread(spark.createDataFrame([(*k, v) for k, v in seeds.items()], "side int, host string, mass long"),
                           spark.createDataFrame(links, "source string, target string, weight long"), rounds=7)
    assert {(r.side, r.host): r.mass for r in got.collect()} == brute_spread(seeds, links, 7, 85)


def test_host_verdicts_of_nothing(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert hosttrust.verdicts(empty, [("block", "x.org/")]).collect() == []
    rows = spark.createDataFrame([(1, "http://x.org/a", None)], "page_id long, url string, html string")
    assert [r.verdict for r in hosttrust.verdicts(rows, []).collect()] == ["allow"]
