"""Every dealt query on the benchmark tables against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tapeglass.llm import digest, huffman, line_templates, neighbour_quality, queries, simhash, tiling, url_templates
from tests.compare import connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall())


def rows(spark, name):
    return queries.queries()[name](spark, SF_DIR).collect()


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def library_ids(name, texts, end):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


def test_sharding(spark, texts):
    found = {r["doc_id"]: r for r in rows(spark, "op1_sharding")}
    assert found.keys() == texts.keys()
    for doc, text in texts.items():
        own = found[doc]
        assert (own["size"], own["text_crc32"]) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
        assert own["grown_shard"] in (own["shard"], 8)
    slots = defaultdict(list)
    for r in found.values():
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    moved = sum(r["grown_shard"] == 8 for r in found.values())
    assert 0.06 < moved / len(found) < 0.17


def test_token_ids(spark, texts):
    found = {r["doc_id"]: r for r in rows(spark, "op2_token_ids")}
    start = 0
    for doc, ids in zip(texts, library_ids("word_bpe_49k.json", texts.values(), 2)):
        assert (found[doc]["start"], found[doc]["n_tokens"], found[doc]["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
    assert len(found) == len(texts)


def test_fingerprints(spark, texts):
    found = {r["doc_id"]: r for r in rows(spark, "op3_fingerprints")}
    ids = list(texts)
    for doc, following in zip(ids, [*ids[1:], ids[0]]):
        text, other = texts[doc], texts[following]
        tail = len(text) // 4
        edited = text[: len(text) - tail] + other[:tail]
        prints = [digest.digest(t.encode()) for t in (text, edited, other)]
        own = found[doc]
        assert (own["n_chars"], own["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (own["fingerprint"], own["edited_fingerprint"]) == (prints[0].hex(), prints[1].hex())
        assert own["near_edited"] == digest.likeness(prints[0], prints[1])
        assert own["near_next"] == digest.likeness(prints[0], prints[2])
    closer = sum(r["near_edited"] > r["near_next"] for r in found.values())
    assert closer > 0.9 * len(found)


def plain_digest(data):
    """Quartile bucket digest, triplet by triplet."""
    counts = [0] * 256
    for kind, (b, c) in enumerate([(2, 5), (3, 7), (4, 9)]):
        for i in range(len(data) - c):
            mixed = data[i] | data[i + b] << 8 | data[i + c] << 16 | kind << 24
            mixed ^= mixed >> 13
            counts[mixed * 0x9E3779B1 % 2**32 >> 24] += 1
    ranked = sorted(counts)
    limits = ranked[63], ranked[127], ranked[191]
    quartiles = [sum(n > limit for limit in limits) for n in counts]
    packed = [sum(q << 2 * k for k, q in enumerate(quartiles[i : i + 4])) for i in range(0, 256, 4)]
    return bytes([min(255, int(8 * math.log2(len(data) + 1))), *packed])


def test_digest_against_a_plain_one(texts):
    some = [t.encode() for t in list(texts.values())[:60]] + [b"", b"abc", b"\0" * 40, "\u00df\u6570".encode() * 7]
    prints = [digest.digest(t) for t in some]
    assert prints == [plain_digest(t) for t in some]
    steps = [0, 1, 2, 6]
    for a, b in zip(prints, prints[1:]):
        quarters = [[byte >> 2 * k & 3 for byte in p[1:] for k in range(4)] for p in (a, b)]
        cost = sum(steps[abs(x - y)] for x, y in zip(*quarters)) + min(32, abs(a[0] - b[0]))
        assert digest.likeness(a, b) == 1 - cost / (6 * 256 + 32)


def test_decontamination(spark, texts, duck):
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    found = {(r["doc_id"], r["item_id"]): r for r in rows(spark, "op4_decontamination")}
    expected = {}
    for doc, text in texts.items():
        words = tiling.words_of(text)
        runs = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        for item, body in items:
            own = tiling.words_of(body)
            if any(tuple(own[i : i + 5]) in runs for i in range(len(own) - 4)):
                under = sum(n for _, _, n in plain_tiles(own, words, 5))
                if under >= tiling.COVERAGE * len(own):
                    expected[doc, item] = under
    assert {k: r["tiled_words"] for k, r in found.items()} == expected
    assert expected


def plain_tiles(item, doc, tile):
    """Greedy string tiling by comparing every pair of positions."""
    free_a, free_b, found = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n] and free_a[a + n] and free_b[b + n]:
                    n += 1
                if n > best[2]:
                    best = (a, b, n)
        if best[2] < tile:
            return found
        a, b, n = best
        free_a[a : a + n], free_b[b : b + n] = [False] * n, [False] * n
        found.append(best)


def plain_simhash(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest key reachable over fingerprints of at most four differing bits."""
    keys = sorted(prints)
    values = np.array([prints[k] for k in keys], np.uint64)
    label = {k: k for k in keys}
    changed = True
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= 4) for v in values]
    while changed:
        changed = False
        for k, others in zip(keys, near):
            least = min(label[keys[o]] for o in others)
            if least < label[k]:
                label[k], changed = least, True
    return label


def test_simhash(spark, texts):
    found = {r["doc_id"]: r for r in rows(spark, "op5_simhash")}
    prints = {doc: plain_simhash(text) for doc, text in texts.items()}
    assert {d: r["fingerprint"] for d, r in found.items()} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {d: r["component_id"] for d, r in found.items()} == plain_components(prints)


@pytest.mark.parametrize(("bucket", "distance"), [(2, 4), (0, 4), (3, 3)])
def test_simhash_with_crowded_values(spark, bucket, distance):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 8, dtype=np.uint64)
    masks = [sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 6))) for _ in range(300)]
    values = np.unique([int(centres[i % 8]) ^ m for i, m in enumerate(masks)]).astype(np.uint64)
    fps = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    made = simhash.components(simhash.links(fps, distance, bucket)).collect()
    label = {r["vertex"]: r["component"] for r in made}
    groups = Counter(label.get(int(v), int(v)) for v in values.view(np.int64))
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ v) <= distance):
            parent[root(i)] = root(int(j))
    assert sorted(groups.values()) == sorted(Counter(root(i) for i in range(len(values))).values())


def test_chat(spark, duck):
    found = {r["conv_id"]: r for r in rows(spark, "op6_chat")}
    turns = defaultdict(list)
    for conv, _, role, text in duck.execute("SELECT * FROM conversations ORDER BY conv_id, turn").fetchall():
        turns[conv].append((role, text or ""))
    turns[-7] = [("user", queries.CONTROL), ("assistant", queries.CONTROL)]
    assert found.keys() == turns.keys()
    for conv, own in turns.items():
        loss = "".join(t for r, t in own if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in own)
        made = found[conv]
        assert (made["n_turns"], made["turns_sha256"]) == (len(own), hashlib.sha256(whole.encode()).hexdigest())
        assert (made["loss_chars"], made["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_packing(spark, texts):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows(spark, "op8_packing"):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert pieces.keys() == texts.keys()
    total = 0
    for doc, ids in zip(texts, library_ids("byte_bpe_50k.json", texts.values(), 0)):
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == crc(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids)
        total += at
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert total > 0.99 * 1024 * len(sequences)


def test_quality(spark, duck, texts):
    found = {r["doc_id"]: r for r in rows(spark, "op9_quality")}
    assert found.keys() == texts.keys()
    for doc, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.3)
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    held = [(labels[d], r["score"], r["predicted"]) for d, r in found.items() if d in labels and r["held_out"]]
    good, bad = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.9
    assert np.mean([y == p for y, _, p in held]) > 0.9


def test_quality_votes_against_plain_ones(spark, texts, duck):
    """Every score is the similarity-weighted share of good labels among the nearest voters, found by plain loops."""
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    voters = neighbour_quality.fit(docs, labels)
    known = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    assert sorted(voters.labels.tolist()) == sorted(float(y) for d, y in known.items() if zlib.crc32(str(d).encode()) % 5)
    some = list(texts.values())[:25] + ["", None]
    kinds = voters._unit((np.stack([neighbour_quality.features(t) for t in some]) - voters.mean) @ voters.axes)
    words = voters._unit(voters.terms.vectors([neighbour_quality.terms(t) for t in some]))
    for score, kind, word in zip(voters.scores(some).tolist(), kinds, words):
        near = []
        for at, label in enumerate(voters.labels.tolist()):
            cosine = (float(kind @ voters.vectors[at]) + float(word @ voters.term_vectors[at])) / 2
            near.append((-cosine, at, label))
        near.sort()
        votes = weight = 0.0
        for minus, _, label in near[: neighbour_quality.NEIGHBOURS]:
            own = max(0.0, -minus) ** neighbour_quality.SHARPNESS
            votes, weight = votes + own * label, weight + own
        smoothing = neighbour_quality.SMOOTHING
        assert abs(score - (votes + smoothing * voters.prior) / (weight + smoothing)) < 1e-4


def plain_line_dedup(texts, min_docs=3, min_tokens=4):
    """(text, dropped lines) by document, with dictionaries."""

    def tokens(line):
        return tuple(re.sub("[ \t\r]+", " ", re.sub("[0-9]+", "<*>", line)).strip(" ").split(" "))

    every = [(doc, tokens(line)) for doc, text in sorted(texts.items()) for line in text.split("\n")]
    every = [(doc, own) for doc, own in every if len(own) >= min_tokens or len(" ".join(own)) >= 20]
    values = defaultdict(list)
    for doc, own in every:
        for at, token in enumerate(own if min_tokens <= len(own) <= 16 else ()):
            values[len(own), own[:2], at, token].append(texts[doc])

    def templates(own):
        found = [("whole", *own)]
        if len(own) > 16:
            half, leaf = len(own) // 2, (len(own), *own[:2])
            found += [("first", leaf, *own[:half]), ("second", leaf, *own[half:])]
        elif len(own) >= min_tokens:
            held = [values[len(own), own[:2], at, token] for at, token in enumerate(own)]
            mask = [len(docs) >= min_docs and len(set(docs)) > 1 for docs in held]
            if sum(mask) < len(own) and sum(mask) >= max(min_tokens, 0.6 * len(own)):
                found.append(("placed", *(token if kept else "*" for token, kept in zip(own, mask))))
        return found

    seen, first, long = defaultdict(set), {}, set()
    for doc, own in every:
        for t in templates(own):
            seen[t].add(texts[doc])
            first.setdefault(t, doc)
            if t[0] == "whole" and len(own) >= 50:
                long.add(t)
    made = {}
    for doc, text in texts.items():
        lines = text.split("\n")
        kept = []
        for line in lines:
            own = tokens(line)
            under = templates(own) if len(own) >= min_tokens or len(" ".join(own)) >= 20 else []
            if not any(len(seen[t]) >= (2 if t in long else min_docs) and first[t] != doc for t in under):
                kept.append(line)
        made[doc] = ("\n".join(kept), len(lines) - len(kept))
    return made


def test_line_dedup(spark, texts):
    found = {r["doc_id"]: (r["text"], r["dropped_lines"]) for r in rows(spark, "op10_line_dedup")}
    assert found == plain_line_dedup(texts)
    assert sum(n for _, n in found.values()) > 10


def test_pipeline(spark, texts, duck):
    """Each stage against brute force on what the stage before it kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        made.append(corpus_pipeline.staged(stage(spark, made[-1], SF_DIR), "test-stage"))
    assert all(d.columns == docs.columns for d in made[:-1])
    kept = [{r["doc_id"]: r["text"] for r in d.collect()} for d in made[:-1]]
    scores = {r["doc_id"]: r["score"] for r in rows(spark, "op9_quality")}
    assert kept[1] == {d: t for d, t in kept[0].items() if scores[d] >= neighbour_quality.ACCEPT_FROM}
    lines = plain_line_dedup(kept[1])
    assert kept[2] == {d: t for d, (t, n) in lines.items() if not n or t.strip(" ")}
    labels = plain_components({d: plain_simhash(t) for d, t in kept[2].items()})
    assert kept[3] == {d: t for d, t in kept[2].items() if labels[d] == d}
    items = tiling.Block(duck.execute("SELECT item_id, text FROM benchmark").fetchall(), tiling.TILE)
    assert kept[4] == {d: t for d, t in kept[3].items() if not items.matches(t, tiling.COVERAGE)}
    assert len(kept[4]) > 0.6 * len(kept[0])
    assert {r["doc_id"] for r in made[5].collect()} == kept[4].keys()


def test_code_lengths_are_shortest():
    counts = np.sort(np.random.default_rng(0).integers(1, 10_000, 200))
    lengths = huffman.code_lengths(counts, 20)
    heap = sorted((int(c), 0) for c in counts)
    cost = 0
    import heapq

    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], 0))
    assert (lengths * counts).sum() == cost
    limited = huffman.code_lengths(counts, 8)
    assert limited.max() <= 8
    assert (0.5**limited).sum() <= 1


def test_line_templates_ignore_copies(spark):
    body = "one two three four five\nsix seven eight nine ten\neleven twelve more words here"
    copies = spark.createDataFrame([(i, body) for i in range(9)], "doc_id long, text string")
    assert line_templates.recurring_templates(copies).count() == 0


def test_line_templates_generalise_by_position(spark):
    """Fields that vary anywhere in a line, in documents of one line and of several; prose of one form stays."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 7))
    orders = [f"Order {i} shipped to the customer" for i in range(1000)]
    news = [f"Posted by {word()} in {word()} news today" for _ in range(100)]
    mixed = [f"{word()} {word()}\nLast seen by {word()} on {word()} at noon\n{word()}" for _ in range(50)]
    prose = [f"The {word()} of {word()} {word()} was {word()} {word()}" for _ in range(200)]
    rows = list(enumerate([*orders, *news, *mixed, *prose]))
    found = {r["doc_id"]: r for r in line_templates.without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    dropped = [sum(found[d]["dropped_lines"] for d, t in rows if t in set(group)) for group in (orders, news, mixed, prose)]
    assert dropped == [999, 99, 49, 0]
    assert {d: (r["text"], r["dropped_lines"]) for d, r in found.items()} == plain_line_dedup(dict(rows))


def test_lines_without_spaces_recur(spark):
    line = "\u6570\u636e" * 15
    rows = [(i, f"{line}\n{i} own") for i in range(4)] + [(9, "Read more\nfew")] * 3
    found = line_templates.without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["dropped_lines"] for r in found) == [0, 0, 0, 0, 1, 1, 1]


def test_url_templates_decide(spark):
    """Pages without a rule are blocked by their template; held-out pages of labelled hosts are judged like the others."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")

    def judged(**options):
        return {r["page_id"]: r for r in url_templates.judge_urls(pages, queries.RULES, **options).collect() if r["rule"] is None}

    def junk(row):
        return any(word in url_templates.JUNK_WORDS for word in re.split("[.-]", row["host"]))

    found, without_tree = judged(), judged(reject_from=2.0)
    blocked = [r for r in found.values() if r["verdict"] == "block"]
    assert len(blocked) > 50 and not any(r["verdict"] == "block" for r in without_tree.values())
    assert all(junk(r) for r in blocked)
    aside = F.pmod(F.xxhash64("page_id"), F.lit(5)) == 0
    held = {r["page_id"] for r in pages.where(aside).select("page_id").collect()}
    rows = [r for page, r in judged(held_out=aside).items() if page in held]
    right = [junk(r) for r in rows if r["verdict"] == "block"]
    caught = [r["verdict"] == "block" for r in rows if junk(r)]
    print("held out: blocked", len(right), "purity", np.mean(right), "of junk pages", len(caught), "caught", np.mean(caught))
    assert np.mean(right) > 0.9 and np.mean(caught) > 0.5


def test_url_templates_need_more_than_one_suspect(spark):
    rows = [(i, f"http://casino.example.net/a/{i}") for i in range(1)] + [(10 + i, f"http://good.example.org/a/{i}") for i in range(30)]
    rows += [(100 + i, f"http://bets.example.net/b/{i}") for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = {r["page_id"]: r["verdict"] for r in url_templates.judge_urls(pages, queries.RULES).collect()}
    assert found[0] == "allow" and found[10] == "allow" and all(found[100 + i] == "block" for i in range(12))
