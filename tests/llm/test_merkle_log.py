"""The Merkle log against a plain tree, and what its docstrings state."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tapeglass.llm import merkle_log, queries
from tests.compare import connect

SF_DIR = "/root/testdata/sf0.01"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def plain_path(levels, i):
    """(before, after) of a leaf's run on every level."""
    path = []
    for below in levels[:-1]:
        start = i - i % 8
        path.append(("".join(below[start:i]), "".join(below[i + 1 : start + 8])))
        i //= 8
    return path


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, path) of (doc_id, source, lang, n_chars, text) rows."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, plain_leaf(row)))
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    built = {lang: plain_levels([leaf for *_, leaf in sorted(trees[lang])]) for lang in order}
    over = plain_levels([built[lang][-1][0] for lang in order])
    made = []
    for place, lang in enumerate(order):
        for i, (known, doc, leaf) in enumerate(sorted(trees[lang])):
            path = plain_path(built[lang], i) + plain_path(over, place)
            made.append((doc if known else None, leaf, built[lang][-1][0], over[-1][0], path))
    return made


def test_query(spark):
    con = connect(SF_DIR)
    rows = con.execute("SELECT doc_id, source, lang, n_chars, text FROM documents").fetchall()
    by_doc = {r[0]: r for r in rows}
    found = {r["doc_id"]: r for r in queries.queries()["op11_merkle"](spark, SF_DIR).collect()}
    assert found.keys() == by_doc.keys()
    broken = 0
    for doc, leaf, subroot, root, path in plain_manifest(rows):
        own = found[doc]
        start = leaf
        if zlib.crc32(str(doc).encode()) % 3 == 0 and by_doc[doc][4] is not None:
            lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in by_doc[doc][4])
            start = plain_leaf((*by_doc[doc][:4], lowered))
        for left, right in path:
            start = h(left + start + right)
        assert (own["leaf"], own["subroot"], own["root"], own["folded_root"]) == (leaf, subroot, root, start)
        assert own["proof_sha256"] == h("".join(a + b for a, b in path))
        assert own["verified"] == (start == root)
        broken += not own["verified"]
    assert 0.2 < broken / len(rows) < 0.4


ROWS = [
    (1, "a", "en", 1, "x"), (1, "a", "en", 1, "x"), (1, "a", "en", 1, "x"), (2, None, None, None, None), (None, "s", "en", 0, ""),
    (3, "ü", "de", 5, "Größe"), (4, "a", "", 1, "1:x"), (5, "a", "en", 1, "long " * 50_000),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, source string, lang string, n_chars long, text string")
    clashing = ["tree", "index", "digest", "leaf", "root", "left", "level", "position", "tie", "key", "_at"]
    return rows.withColumns({name: F.lit("x") for name in clashing})


def found_manifest(docs, **options):
    made = merkle_log.manifest(docs, queries.LEAF_COLUMNS, **options)
    return sorted(
        ((r["doc_id"], r["leaf"], r["subroot"], r["root"], list(zip(r["left"], r["right"]))) for r in made.collect()), key=repr
    )


def test_edges(docs):
    assert found_manifest(docs) == sorted(plain_manifest(ROWS), key=repr)
    assert found_manifest(docs.where("1 = 0")) == []
    assert found_manifest(docs.where("doc_id = 3")) == sorted(plain_manifest([ROWS[5]]), key=repr)
    carried = merkle_log.manifest(docs, ["text"], carried={"chars": F.length("text")}).select("doc_id", "chars").collect()
    assert sorted((r["doc_id"] or 0, r["chars"] or 0) for r in carried) == sorted((r[0] or 0, len(r[4] or "")) for r in ROWS)


@pytest.mark.parametrize("size", [1, 7, 8, 9, 63, 64, 65, 511, 513, 4100])
def test_trees_of_many_sizes(spark, size):
    """Several levels of builders, whose blocks end anywhere; places are those of a plain postorder."""
    digests = [h(str(i)) for i in range(size)]
    levels = plain_levels(digests)
    rows = spark.createDataFrame([("t", i, d) for i, d in enumerate(digests)], "tree string, at long, digest string")
    log = merkle_log.append_log(rows.repartition(3), ["at"], ["at"])
    nodes = sorted((r["position"], r["level"], r["index"], r["digest"]) for r in log.all_nodes().collect())
    order = []

    def visit(level, index):
        for child in range(8 * index, min(8 * index + 8, len(levels[level - 1]))) if level else ():
            visit(level - 1, child)
        order.append((len(order), level, index, levels[level][index]))

    visit(len(levels) - 1, 0)
    assert nodes == order
    paths = {r["at"]: (r["top"], list(zip(r["left"], r["right"]))) for r in merkle_log.proofs(log).collect()}
    assert paths == {i: (levels[-1][0], plain_path(levels, i)) for i in range(size)}
    asked = spark.createDataFrame([("t", size - 1), ("t", size // 2), ("t", size), ("other", 0)], "tree string, index long")
    runs = {}
    for r in merkle_log.extracted(log, asked).collect():
        runs.setdefault(r["index"], {}).setdefault(r["level"], []).append((r["sibling"], r["digest"]))
    for i in {size - 1, size // 2}:
        texts = ["".join(d for _, d in sorted(runs.get(i, {}).get(level, []))) for level in range(len(levels) - 1)]
        assert texts == [a + b for a, b in plain_path(levels, i)]
    assert runs.keys() <= {size - 1, size // 2}


def test_a_hot_key_is_no_single_range(spark, monkeypatch):
    """Rows of one key and one text fill several ranges and blocks."""
    monkeypatch.setattr(merkle_log, "RANGE_ROWS", 200)
    rows = [(1, "a", "en", 1, "x")] * 1200 + [(i, "a", "en", 1, "y") for i in range(2, 100)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    made = {(r["leaf"], r["root"]) for r in merkle_log.manifest(docs, queries.LEAF_COLUMNS).collect()}
    assert made == {(leaf, root) for _, leaf, _, root, _ in plain_manifest(rows)}
