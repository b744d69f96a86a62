"""NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing columns in every operator."""

import pickle

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tapeglass.llm import (
    bm25_packing, chat, common, components, digest, huffman, line_templates, neighbour_quality, sharding, simhash, tiling,
    tokens, url_templates,
)
from tapeglass.session import scratch_folder

WORD = (public_tokenizers.path("word_bpe_49k.json"), "dropped", 2)
BYTE = (public_tokenizers.path("byte_bpe_50k.json"), "kept", 0)
LONG = "the quick brown fox jumps over a lazy dog " * 5000
TEXTS = [
    (1, "plain words of a text that is long enough to matter"), (2, None), (3, ""), (4, LONG), (5, "  \n\t "),
    (6, "same text here"), (7, "same text here"), (7, "same text here"), (None, "no key at all"), (8, "ÀÉ 数字 \x0b\x85x\u00a0 y"),
]
BENCHMARK = [(0, "quick brown fox jumps over a lazy dog the"), (1, ""), (2, None), (3, "two words"), (None, "no key at all")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string")
    clashing = ["part", "key", "fp", "shard", "slot", "bucket", "_key", "dropped_lines", "score", "ids", "template", "p"]
    return rows.withColumns({name: F.lit("x") for name in clashing})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("1 = 0")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(BENCHMARK, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (4, 0), (6, None), (99, 1), (None, 0)], "doc_id long, quality int")


def test_sharding(docs, none):
    tree = sharding.uniform_tree(3)
    rows = sharding.shard_documents(docs, tree).collect()
    assert len(rows) == len(TEXTS)
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 3)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    nothing = next(r for r in rows if r["doc_id"] == 2)
    assert (nothing["size"], nothing["text_crc32"]) == (1, 0)
    assert sharding.shard_documents(none, tree).collect() == []
    with pytest.raises(ValueError):
        sharding.place(F.col("doc_id"), [])


def test_sharding_moves_only_within_changed_subtrees(spark):
    keys = spark.range(4000)
    tree = sharding.uniform_tree(8)
    heavier = [sharding.Shard(s.region, s.rack, s.number, 3.0 if s.number == 5 else 1.0) for s in tree]
    rows = keys.select(
        sharding.place(F.col("id"), tree).alias("a"), sharding.place(F.col("id"), heavier).alias("b")
    ).collect()
    moved = [(r["a"], r["b"]) for r in rows if r["a"] != r["b"]]
    assert moved
    # Shard 5 stands in rack2 of region1: nothing moves inside region0, and nothing moves out of the heavier rack.
    assert all(not (a.startswith("region0") and b.startswith("region0")) for a, b in moved)
    assert all(b.startswith("region1/rack2") or a.startswith("region1/rack3") is False for a, b in moved)
    share = sum(r["b"].endswith("/5") for r in rows) / 4000
    assert abs(share - 0.3) < 0.03


def test_sharding_folders(spark, docs, tmp_path):
    sharding.write_shards(docs.select("doc_id", "text"), sharding.uniform_tree(3), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(TEXTS)


@pytest.mark.parametrize("tokenizer", [WORD, BYTE])
def test_pieces_encode_like_whole_texts(tokenizer):
    from tokenizers import Tokenizer

    rng = np.random.default_rng(0)
    signs = list("ab Zé.'\n\t  \r!|9<>\x0b\u2003\u0301\u03a3数\x1c") + ["'s", "<|endoftext|>", " the"]
    made = ["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(400)]
    made += [" ".join(rng.choice(["Größe", "the", "a", "x.", "y,", "\n", "\n\n", "\nb", "c\n", "", "ÀÉ", "it's"], rng.integers(0, 9))) for _ in range(600)]
    whole = Tokenizer.from_file(tokenizer[0])
    own = tokens.Encoder(*tokenizer)
    for text, raw in zip(made, own.encode(made)):
        expected = whole.encode(text, add_special_tokens=False).ids + [tokenizer[2]]
        assert np.frombuffer(raw, own.dtype).tolist() == expected, repr(text)
    assert own.direct and own.compared


def test_a_model_that_differs_from_its_tokenizer_is_not_used(monkeypatch):
    own = tokens.Encoder(*WORD)
    monkeypatch.setattr(own, "_modelled", lambda words, lead: [b"\0\0"] * len(words))
    assert own.encode(["some plain words"]) == tokens.Encoder(*WORD).encode(["some plain words"])
    assert not own.direct


@pytest.mark.parametrize("tokenizer", [WORD, BYTE])
def test_words_with_signs_behind_them_share_the_ids_of_the_word(tokenizer, monkeypatch):
    from tokenizers import Tokenizer

    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("aeklmnorstÉéü"), 9)) for _ in range(2000)]
    signs = rng.choice(["%%%", ".***", "_`", "!!", "-", "<", ".\n", "'s", "&'", "(9", "|é"], 2000, p=[0.9, *[0.01] * 10])
    signed = [f"{word}{sign}" for word, sign in zip(words, signs)]
    made = [" ".join(signed[i : i + 9]) for i in range(0, 2000, 9)]
    whole = Tokenizer.from_file(tokenizer[0])
    own, given = tokens.Encoder(*tokenizer), []
    library = own._library
    monkeypatch.setattr(own, "_library", lambda pieces: given.extend(pieces) or library(pieces))
    for text, raw in zip(made, own.encode(made)):
        assert np.frombuffer(raw, own.dtype).tolist() == whole.encode(text, add_special_tokens=False).ids + [tokenizer[2]], repr(text)
    # Compared words, other pieces and signs, but not each of 1800 words once more with its signs. In `kept` mode the
    # first words of the texts are pieces too.
    assert own.direct and len(given) < tokens.COMPARED + 300


@pytest.mark.parametrize("tokenizer", [WORD, BYTE])
def test_slices_of_texts_and_full_tables_give_the_same_ids(tokenizer, monkeypatch):
    import pyarrow as pa

    texts = [None, "", " ", "a", "a ", " a", "x y. z&& x", "ab " * 400, "é\n\nb", "a\tb", *(f"{w} &{w} {w}." for w in ["ab", "cd", "éf"] * 9)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    expected = tokens.Encoder(*tokenizer).encode(texts)
    assert [part.num_rows for part in tokens.slices(batch)] == [len(texts)] and tokens.Encoder(*tokenizer).encode([]) == []
    monkeypatch.setattr(tokens, "TEXTS_AT_ONCE", 4)
    monkeypatch.setattr(tokens, "BYTES_AT_ONCE", 30)
    monkeypatch.setattr(tokens, "KEPT_PIECES", 2)
    parts, own = list(tokens.slices(batch)), tokens.Encoder(*tokenizer)
    assert [t for part in parts for t in part.column(1).to_pylist()] == texts
    assert all(p.num_rows == 1 or p.num_rows <= 4 and sum(len((t or "").encode()) for t in p.column(1).to_pylist()) <= 30 for p in parts)
    assert [raw for part in parts for raw in own.encode(part.column(1).to_pylist())] == expected


def test_special_tokens_in_a_text_are_what_the_library_makes_of_them():
    for tokenizer, special in ((WORD, 49407), (BYTE, 50256)):
        own = tokens.Encoder(*tokenizer)
        assert special in np.frombuffer(own.encode(["a <|endoftext|> b"])[0], own.dtype).tolist()


def test_huffman(spark, docs, none):
    back = huffman.huffman_round_trip(docs, scratch_folder(spark, "edge"), *WORD).collect()
    expected = {doc: np.frombuffer(raw, "<u2").astype("<u4").tobytes() for (doc, text), raw in zip(TEXTS, tokens.Encoder(*WORD).encode([t for _, t in TEXTS]))}
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in back) == sorted((d is not None, d or 0) for d, _ in TEXTS)
    at = 0
    for r in sorted(back, key=lambda r: r["start"]):
        assert (r["start"], bytes(r["ids"])) == (at, expected[r["doc_id"]])
        at += r["n_tokens"]
    assert huffman.huffman_round_trip(none, scratch_folder(spark, "edge"), *WORD).collect() == []


def test_huffman_over_many_parts_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK_IDS", 50)
    rng = np.random.default_rng(3)
    made = {int(d): rng.integers(0, 300, rng.integers(1, 700)).astype("<u2") for d in rng.permutation(200)}
    coded = spark.createDataFrame([(d, bytearray(i.tobytes()), 2) for d, i in made.items()], "doc_id long, ids binary, width int")
    path = scratch_folder(spark, "edge")
    huffman.write_ids(coded.repartition(5), path, max_bits=10, part_ids=9000)
    assert spark.read.parquet(f"{path}/blocks").select("part").distinct().count() > 3
    assert max(spark.read.parquet(f"{path}/code").first()["lengths"]) <= 10
    at = 0
    for r in sorted(huffman.read_ids(spark, path).collect(), key=lambda r: r["doc_id"]):
        assert (r["start"], bytes(r["ids"])) == (at, made[r["doc_id"]].astype("<u4").tobytes())
        at += r["n_tokens"]


@pytest.mark.parametrize("range_rows", [1, 3, 1000])
def test_digests(docs, none, range_rows):
    rows = digest.edited_fingerprints(docs, range_rows=range_rows).collect()
    assert len(rows) == len(TEXTS)
    ordered = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    following = {doc: ordered[(i + 1) % len(ordered)][1] or "" for i, (doc, _) in enumerate(ordered)}
    for r in rows:
        text = dict(TEXTS)[r["doc_id"]] or ""
        tail = len(text) // 4
        options = {following[r["doc_id"]], "same text here"} if r["doc_id"] == 7 else {following[r["doc_id"]]}
        edited = {(text[: len(text) - tail] + o[:tail]) for o in options}
        assert r["edited_fingerprint"] in {digest.digest(e.encode()).hex() for e in edited}
    assert digest.edited_fingerprints(none).collect() == []
    assert digest.fingerprints(docs).count() == len(TEXTS)
    single = digest.edited_fingerprints(docs.where("doc_id = 1")).first()
    assert single["near_next"] == 1.0


def test_digest_differences_are_bounded():
    rng = np.random.default_rng(5)
    prints = [digest.digest(rng.bytes(n)) for n in (0, 1, 2, 3, 50, 5000)]
    for a in prints:
        assert digest.likeness(a, a) == 1.0
        for b in prints:
            assert 0.0 <= digest.likeness(a, b) <= 1.0 and digest.difference(a, b) == digest.difference(b, a)


def test_tiling(spark, docs, none, benchmark):
    pairs = {(r["doc_id"], r["item_id"]): r for r in tiling.contaminated(docs, benchmark).collect()}
    assert set(pairs) == {(4, 0), (None, None)}
    assert pairs[4, 0]["coverage"] == 1.0
    kept = tiling.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 5, 6, 7, 7, 8]
    assert tiling.contaminated(none, benchmark).collect() == []
    assert tiling.contaminated(docs, benchmark.where("1 = 0")).collect() == []
    assert tiling.decontaminated(docs, benchmark.where("1 = 0")).count() == len(TEXTS)


def test_tiling_finds_reordered_passages_and_takes_blocks(spark):
    words = [f"w{i}" for i in range(60)]
    moved = words[40:] + ["x"] + words[20:40] + ["y"] + words[:20]
    docs = spark.createDataFrame([(1, " ".join(moved)), (2, " ".join(words[:20]))], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(words if i == 5 else [f"v{i}"] * 9)) for i in range(40)], "item_id long, text string")
    for block_words in (10, 1000):
        found = tiling.contaminated(docs, items, block_words=block_words).collect()
        assert [(r["doc_id"], r["item_id"], r["tiled_words"], len(r["tiles"])) for r in found] == [(1, 5, 60, 3)]


def test_tiles_match_a_plain_search():
    from tests.llm.test_results import plain_tiles

    rng = np.random.default_rng(2)
    for _ in range(60):
        item, doc = rng.integers(0, 3, rng.integers(1, 30)), rng.integers(0, 3, rng.integers(1, 60))
        fast, plain = tiling.tiles(item, doc, 3), plain_tiles(item.tolist(), doc.tolist(), 3)
        longest = max((n for _, _, n in plain), default=0)
        assert max((n for _, _, n in fast), default=0) == longest or len(item) < 3
        used = [a for a, _, n in fast for a in range(a, a + n)]
        assert len(used) == len(set(used))


def test_simhash(docs, none):
    rows = simhash.near_duplicates(docs, 4, 4).collect()
    assert len(rows) == len(TEXTS)
    by = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows}
    assert by[2] == by[3] == by[5] == ("0" * 16, 2)
    assert by[6] == by[7] and by[7][1] == 6
    assert by[None][1] is None
    kept = simhash.without_near_duplicates(docs, 4, 4)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 4, 6, 8]
    assert simhash.near_duplicates(none, 4, 4).collect() == []
    assert simhash.without_near_duplicates(none, 4, 4).collect() == []


@pytest.mark.parametrize(("parts", "distance"), [(4, 4), (3, 4), (2, 4), (4, 1), (4, 0), (2, 7)])
def test_thresholds_add_up(parts, distance):
    rng = np.random.default_rng(0)
    fps = rng.integers(-(1 << 62), 1 << 62, 300)
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    groups = simhash.bit_groups(bits.T @ bits, bits.sum(axis=0), 300, parts)
    assert sorted(b for g in groups for b in g) == list(range(64))
    halves = [simhash.Plan.halves(g) for g in groups]
    counts = [[np.bincount(simhash._pick_array(fps, b), minlength=1 << len(b)) for b in own] for own in halves]
    found = simhash.Plan(groups, counts, 300, distance, 10).thresholds(fps)
    assert (found.sum(axis=0) == distance - parts + 1).all() and found.min() >= -1


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 300)]
    rows = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {(r["vertex"], r["component"]) for r in rows} == {(i, 0) for i in range(101)} | {(1000 + i, 1000) for i in range(300)}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_plans_of_near_duplicates_stay_small_on_the_driver(spark, monkeypatch):
    rng = np.random.default_rng(0)
    fps = spark.createDataFrame([(int(v),) for v in rng.integers(-(1 << 62), 1 << 62, 50)], "fp long")
    fps = common.staged(fps, "few-fingerprints")
    for linked in (simhash._midpoint_links(fps, 4), simhash.links(fps, 4)):
        planned = linked._jdf.queryExecution()
        assert "Broadcast" not in planned.sparkPlan().toString() and len(planned.optimizedPlan().toString()) < 20_000
    plan = simhash._plan(fps, 4, 10)
    assert len(pickle.dumps(plan)) < 1.1 * 8 * sum(1 << len(bits) for bits in plan.groups)
    folds = []

    def staged(df, purpose):
        folds.append(df._jdf.queryExecution().sparkPlan().toString().count("HashAggregate"))
        return common.staged(df, purpose)

    monkeypatch.setattr(components, "staged", staged)
    components.components(spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")).collect()
    assert len(folds) > 3 and max(folds) <= 8


def test_midpoint_links_connect_what_is_near(spark):
    rng = np.random.default_rng(1)
    fps = [int(v) for v in rng.integers(-(1 << 63), (1 << 63) - 1, 6)]
    for flips in (1, 2, 3, 4, 5):
        fps += [int(np.int64(fps[0]) ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, flips, False))).view(np.int64))]
    fps = list(dict.fromkeys([*fps, 0, -1]))
    found = components.components(simhash._midpoint_links(spark.createDataFrame([(v,) for v in fps], "fp long"), 4)).collect()
    near = {v: {v} for v in fps}
    for v, w in [(v, w) for _ in fps for v in fps for w in fps]:
        if bin((v ^ w) & (2**64 - 1)).count("1") <= 4:
            near[v] = near[w] = near[v] | near[w]
    assert {r["vertex"]: r["component"] for r in found} == {v: min(near[v]) for v in fps if len(near[v]) > 1}


def test_chat(spark):
    odd = ["", None, "\\", "\\\\", "###", "\\###", "######", "</turn>", "\\</turn>\\", "### user: a</turn>\n", "</turn>\n### x: ", "é\u2028"]
    rows = [(1, i, role, text) for i, (role, text) in enumerate((r, t) for r in ("user", "assistant", "a: b", ":\\", None) for t in odd)]
    rows += [(2, None, "assistant", "x"), (2, 0, "assistant", "y"), (2, 0, "assistant", "y"), (None, 0, "user", "z")]
    said = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(1))
    segments = chat.format_turns(said)
    back = {r["conv_id"]: r for r in chat.read_back(segments).collect()}
    assert {c: r["n_turns"] for c, r in back.items()} == {1: len(odd) * 5, 2: 3, None: 1}
    assert back[2]["loss_chars"] == 3
    whole = {r["conv_id"]: r["formatted"] for r in chat.formatted_texts(segments).collect()}
    assert [t[:2] for t in chat.parse(whole[1])] == [(role or "", text or "") for _, _, role, text in rows[: len(odd) * 5]]
    assert {c: len(t) for c, t in whole.items()} == {c: r["formatted_chars"] for c, r in back.items()}
    assert chat.read_back(chat.format_turns(said.where("1 = 0"))).collect() == []


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://Ex.ORG", "http://ex.org/a?b://c", "x://h#f/g", "http://a/b/c/d/e/f/g/h", "http://É.com/de/1"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(4, urls[4])], "page_id long, url string").withColumn("host", F.lit("x"))
    rules = [url_templates.Rule("com", "/de/", "block"), url_templates.Rule("org", "", "allow")]
    rows = {r["page_id"]: r for r in url_templates.judge_urls(pages, rules).collect()}
    assert len(rows) == len(urls)
    assert [(rows[i]["host"], rows[i]["path"]) for i in range(len(urls))] == [
        ("", ""), ("", ""), ("", ""), ("", ""), ("ex.org", ""), ("ex.org", "/a"), ("h", ""), ("a", "/b/c/d/e/f/g/h"), ("É.com", "/de/1")
    ]
    assert (rows[8]["rule"], rows[8]["verdict"], rows[4]["rule"]) == ("com/de/", "block", "org")
    assert {r["verdict"] for r in rows.values()} <= {"allow", "block"}
    assert url_templates.judge_urls(pages.where("1 = 0"), rules).collect() == []
    assert url_templates.judge_urls(pages, []).where("verdict IS NULL").count() == 0


def test_url_branches_that_differ_stay_apart(spark):
    made = [(f"h.net/{kind}/{i}", bad) for kind, bad in (("ads", 1), ("news", 0), ("blog", 0)) for i in range(40)]
    rows = spark.createDataFrame([(u.split("/")[0], "/" + u.split("/", 1)[1], b) for u, b in made], "host string, path string, bad long")
    found = url_templates.judged_templates(url_templates.path_templates(rows)).collect()
    shares = {r["template"]: r["bad_share"] for r in found}
    assert shares["h.net/ads/*"] > 0.8 and all(s < 0.4 for t, s in shares.items() if t != "h.net/ads/*")


def test_packing(docs, none):
    rows = bm25_packing.pack(docs, *BYTE).collect()
    own = tokens.Encoder(*BYTE).encode([t for _, t in TEXTS])
    assert sum(r["length"] for r in rows) == sum(len(raw) // 2 for raw in own)
    filled = {}
    for r in rows:
        filled[r["sequence_id"]] = filled.get(r["sequence_id"], 0) + r["length"]
    assert sorted(filled.values())[1:] == [1024] * (len(filled) - 1)
    assert {r["doc_id"] for r in rows} == {d for d, _ in TEXTS}
    assert bm25_packing.pack(none, *BYTE).collect() == []


def test_packing_takes_neighbours_first():
    idf = np.ones(10)
    tails = [[i, 0, 0, np.array([i % 2 * 5 + 1] * 4, "<u2")] for i in range(8)]
    sequences, left = bm25_packing._fill(tails, idf, 4.0, 8, True)
    assert left == [] and [[d for d, *_ in s] for s in sequences] == [[0, 2], [1, 3], [4, 6], [5, 7]]


def test_quality(docs, none, labels):
    voters = neighbour_quality.fit(docs, labels)
    rows = neighbour_quality.quality_scores(docs, voters).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert neighbour_quality.accepted(docs, voters, accept_from=0.0).columns == docs.columns
    assert neighbour_quality.accepted(docs, voters, accept_from=0.0).count() == len(TEXTS)
    assert neighbour_quality.quality_scores(none, voters).collect() == []
    unknown = neighbour_quality.fit(none, labels)
    assert {r["score"] for r in neighbour_quality.quality_scores(docs, unknown).collect()} == {0.5}


def test_quality_learns_words(spark):
    """Bad and good texts of one pattern of letters that differ in their words alone; the same in Chinese."""
    draw = np.random.default_rng(1)
    sets = [[f"{c}{d}{e}{tail}" for c in "bdfg" for d in "aeio" for e in "lmnr"] for tail in ("ka", "pu")]
    han = [["".join(chr(start + c) for c in pair) for pair in draw.integers(0, 100, (40, 2))] for start in (0x4E00, 0x6000)]
    made = []
    for i in range(400):
        good = i % 2
        made.append((i, " ".join(draw.choice(sets[good], 30)) if i < 200 else "".join(draw.choice(han[good], 60)), good))
    rows = spark.createDataFrame([(i, t) for i, t, _ in made], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in made], "doc_id long, quality int")
    scores = {r["doc_id"]: r["score"] for r in neighbour_quality.quality_scores(rows, neighbour_quality.fit(rows, labels)).collect()}
    left = {r["doc_id"] for r in rows.where(neighbour_quality.held_out()).collect()}
    assert len(left) > 50
    assert all((scores[i] > 0.5) == bool(y) for i, _, y in made if i in left)


def test_line_dedup(spark, docs, none):
    banner = "click 12 times to read more"
    body = [(i, f"{banner.replace('12', str(i))}\n{'x' * (i + 1)} own words of page\n{LONG if i == 3 else ''}") for i in range(5)]
    rows = spark.createDataFrame([*body, (9, banner), (None, f"{banner}\nrest of it here now"), (10, None), (11, "")], "doc_id long, text string")
    found = {r["doc_id"]: (r["text"], r["dropped_lines"]) for r in line_templates.without_recurring_lines(rows).collect()}
    assert found[None] == (f"{banner}\nrest of it here now", 0)
    assert found[0] == ("x own words of page\n", 1) and found[9] == ("", 1)
    keyed = line_templates.without_recurring_lines(rows.where("doc_id IS NOT NULL"))
    assert {r["doc_id"]: r["dropped_lines"] for r in keyed.collect()} == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 9: 1, 10: 0, 11: 0}
    assert found[10] == (None, 0) and found[11] == ("", 0)
    same = line_templates.without_recurring_lines(docs)
    assert same.count() == len(TEXTS) and sorted(same.columns) == sorted(docs.columns)
    assert line_templates.without_recurring_lines(none).collect() == []


def test_line_dedup_counts_unrelated_documents(spark):
    """Documents of one line, of a blank line between, and of few lines under one header."""
    names = ["anna", "ben", "carl", "dora", "emil"]
    passage, header = "a passage that stands in all of these documents", "the header of all pages of this site"
    lone = [(i, f"Order {i} shipped to the customer") for i in range(5)]
    blank = [(10 + i, f"{n} wrote this own line\n\n{passage}") for i, n in enumerate(names)]
    pages = [(20 + i, f"{header}\n{n} and nobody else") for i, n in enumerate(names)]
    copies = [(30 + i, "a text that was copied\nword for word as it is") for i in range(5)]
    rows = spark.createDataFrame([*lone, *blank, *pages, *copies], "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in line_templates.without_recurring_lines(rows).collect()}
    assert [found[i] for i in range(5)] == [lone[0][1], "", "", "", ""]
    assert [found[10 + i] for i in range(5)] == [blank[0][1], *(f"{n} wrote this own line\n" for n in names[1:])]
    assert [found[20 + i] for i in range(5)] == [pages[0][1], *(f"{n} and nobody else" for n in names[1:])]
    assert all(found[i] == t for i, t in copies)


def test_line_dedup_takes_long_lines_from_two_documents(spark):
    passage = " ".join(f"word{'abcdefghij'[i % 10] * (i // 10 + 1)}" for i in range(60))
    edited = [(i, f"{passage}\nthe {n} edit of it\n{passage.replace('worda ', n + ' ')}") for i, n in enumerate(["first", "second"])]
    apart = [(5, f"a page on gardens\n{'x ' * 49}x"), (6, f"news about sports\n{'x ' * 49}x"), (7, f"one more page\n{'y ' * 48}y"), (8, f"two more pages\n{'y ' * 48}y")]
    rows = spark.createDataFrame([*edited, *apart], "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in line_templates.without_recurring_lines(rows).collect()}
    assert found[0] == edited[0][1] and found[1] == edited[1][1].split("\n", 1)[1]
    assert (found[5], found[6]) == (apart[0][1], "news about sports")
    assert (found[7], found[8]) == (apart[2][1], apart[3][1])


def test_pipeline_stages_on_edge_rows(spark, docs, benchmark, labels, tmp_path):
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    full = docs.select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("n_chars"))
    for start in (full, full.where("1 = 0")):
        rows = start
        for _, stage in corpus_pipeline.STAGES:
            rows = corpus_pipeline.staged(stage(spark, rows, str(tmp_path)), "edge-stage")
        assert {"doc_id", "sequence_id"} <= set(rows.columns)
