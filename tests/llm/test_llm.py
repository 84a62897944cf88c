"""The training-data operators against SQL, brute force and exact round trips, and on edge rows."""

import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from conftest import SF, same
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexmill.llm import licenses, line_dedup, media, mixing, mpeg, near_copies, packing, quality, queries, simhash, token_orc, tokens, toxicity, url_filter

EDGE = [(1, None, "s"), (2, "", None), (3, " \n ", "s"), (4, "one two three", "s"), (4, "one two three", "s"), (None, "a null id", "t"), (5, "wörd " * 30000, "t"), (6, "One  two\tthree\r\n\nx.y, z!", "s")]


@pytest.fixture
def edge(spark):
    return spark.createDataFrame(EDGE, "doc_id long, text string, source string").withColumns({"n_words": F.lit("clash"), "score": F.lit("clash"), "fp": F.lit("clash")})


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, duck, name):
    same(queries.QUERIES[name](spark, SF), duck.execute(queries.oracle_sql()[name]))


def test_url_edges(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://EXAMPLE.org/en/17"), (4, "x://a.b.example.org/es/1?q#f"), (5, "http://example.org"), (6, "http://a.com/de/://x"), (6, "http://a.com/de/://x"), (7, "http://Spam-Farm.example.net/q")]
    got = sorted(url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), url_filter.listing(spark), ["page_id", "url"]).drop("url").collect())
    assert [tuple(r) for r in got] == [(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "example.org", "/en/17", "example.org/en/1", "block"), (4, "a.b.example.org", "/es/1", "example.org/es/", "block"), (5, "example.org", "", None, "allow"), (6, "a.com", "/de/://x", "com/de/", "block"), (6, "a.com", "/de/://x", "com/de/", "block"), (7, "spam-farm.example.net", "/q", None, "block")]


def test_media_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 1417, 50_000):
        raw = rng.integers(0, 256, n, dtype=np.uint8).tobytes()
        stored = mpeg.carry(media.pad(raw), n)
        got = media.read(stored)
        assert (got["n_bytes"], got["payload_sha256"]) == (n, hashlib.sha256(media.pad(raw)).hexdigest())
        assert got["crc_bad"] == got["skipped_bytes"] == 0 and got["n_samples"] == 1152 * got["n_frames"]


def test_media_resync_and_checksums():
    payload = media.pad(b"text " * 2000)
    stored = mpeg.carry(payload, 10_000)
    first = mpeg.scan(stored)
    noisy = stored[: first.offsets[2]] + b"noise\xff\xe0" * 20 + stored[first.offsets[2] :]
    again = mpeg.scan(noisy)
    assert b"".join(again.bodies) == b"".join(first.bodies) and again.skipped == 140
    hurt = bytearray(stored)
    hurt[first.offsets[1] + 10] ^= 1
    assert mpeg.scan(bytes(hurt)).crc_bad == 1
    assert first.vbr["frames"] == first.frames and first.vbr["bytes"] == len(stored) - first.offsets[0] + 144


@pytest.mark.parametrize(("file", "kind"), [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_tokens_equal_the_library(file, kind):
    enc, tok = tokens.Encoder(public_tokenizers.path(file), kind), Tokenizer.from_file(public_tokenizers.path(file))
    for text in ["", " ", "a", " lead and trail ", "two  spaces\n\nlines\tand tabs", "don't, won't; 12.5!?", "é e\u0301 İ Σς ǅ", "no\u00a0break\u2003em", "<|endoftext|> x", "x<|startoftext|>y <|END<|endoftext|>", "日本語。テスト", "x\x00y\x1cz", "Ünï-cödé_1 a.b.c", *(t for _, t, _ in EDGE if t)]:
        assert np.frombuffer(enc.encode(text.encode()), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_packing_places_each_id_once(spark, edge):
    rows = packing.pack(edge, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=True).collect()
    enc = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), "byte")
    want = sorted(enc.encode((t or "").encode()) + bytes(4) for _, t, _ in EDGE)
    sequences, docs = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
        docs.setdefault((r["doc_id"] or -1, r["doc_tokens"]), []).append(r)
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"]
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024 and at & (at - 1) == 0  # no padding
    assert sum(r["length"] for r in rows) == sum(len(x) // 4 for x in want)


def test_token_files(spark, edge, tmp_path):
    token_orc.write_ids(edge, str(tmp_path / "o"), public_tokenizers.path("word_bpe_49k.json"))
    got = token_orc.digest(token_orc.read_ids(spark, str(tmp_path / "o"))).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 4, 5, 6]
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]


def test_simhash_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(spark.createDataFrame([(900001, "", "en", "s", 0), (900002, None, "en", "s", 0), (900003, "x", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long"))
    got = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.near_duplicates(docs, ["doc_id"]).collect()}

    def plain(text):
        w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
        s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    want = {r["doc_id"]: plain(r["text"]) for r in docs.collect()}
    root = {d: d for d in want}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(want)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (want[a] ^ want[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert got == {d: (want[d], find(d)) for d in want}


def test_golay_keys_never_miss():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)) | (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64))
    sets = []
    for x in (a, a ^ flips):
        rows, key = simhash.keys(x)
        own = [set() for _ in x]
        for r, k in zip(rows, key, strict=True):
            own[r].add(int(k))
        sets.append(own)
    assert all(p & q for p, q in zip(*sets, strict=True))


def test_dense_group_links(spark):
    rows = [(int(x),) for x in {0b1 << k for k in range(20)} | {0b11 << k for k in range(20)} | {0}]
    edges = simhash.links(spark.createDataFrame(rows, "fp long"))
    assert {r["root"] for r in simhash.components(edges).collect()} == {0}


def test_licenses():
    scan = licenses.Scanner().scan
    assert scan(b"Under the MIT-License; cc by nc cc by nc")[:6] == (10, 3, 0, 7, "cc-by-nc,mit", "cc-by-nc,mit")
    assert scan(b"")[:6] == (0, 0, None, None, "", "")
    assert licenses.parse("mit or (apache-2.0 and gpl-2.0-only with classpath-exception-2.0)") == ["mit", "apache-2.0", "gpl-2.0-only", "classpath-exception-2.0", "with", "and", "or"]
    assert licenses.evaluate(licenses.parse("gpl-3.0 or mit"))[0] == pytest.approx(0.1)
    assert "apache-2,mit" == scan(b"# SPDX-License-Identifier: MIT OR Apache-2.0\n")[5]


def judged_by_hand(rows):
    """(doc, line_no) -> first line of an equal set, how many other sets match, whether it goes; rows: (doc, text)."""
    order = lambda place: (place[0] is None, place[0] or 0, place[1])
    places = {}
    for d, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            if line.split():
                places.setdefault((d, i), []).append(frozenset(line.lower().split()))
    first = {}
    for place in sorted(places, key=order):
        for w in places[place]:
            first.setdefault(w, place)
    sets, links = list(first), {w: [] for w in first}
    for i, a in enumerate(sets):
        for b in sets[i + 1 :]:
            if 5 * len(a & b) >= 4 * len(a | b):
                links[a].append(b)
                links[b].append(a)
    gone = lambda place, w: order(place) > order(first[w]) or any(order(first[x]) < order(first[w]) for x in links[w])
    return sorted((order(p), order(first[w]), len(links[w]), gone(p, w)) for p, all_ in places.items() for w in all_)


def near_group(rng, size, words, edits):
    """Copies of one line of so many words, with up to so many edits each (a word changed, left out or put in)."""
    base, out = [f"v{rng.integers(400)}" for _ in range(words)], []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.integers(edits + 1)):
            at = int(rng.integers(len(w)))
            w[at : at + int(rng.integers(2))] = [f"v{rng.integers(400)}"] * int(rng.integers(2))
        out.append(" ".join(w))
    return out


def test_lines_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    for words, edits in ((5, 1), (9, 2), (14, 3), (30, 5), (60, 9)):
        some = near_group(rng, 60, words, edits)
        rows += [(10_000 + int(rng.integers(5000)), "\n".join(some[k : k + 3])) for k in range(0, 60, 3)]
    rows += [(None, "a null id\n\nof three lines and some words\n \n"), (None, None), (20_000, ""), (20_001, "One two three four five"), (20_002, "FIVE four three two one\none two three four")]
    rows = list({d: (d, t) for d, t in rows}.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = lambda d, i: (d is None, d or 0, i)
    got = sorted((order(r["doc_id"], r["line_no"]), order(r["first_doc"], r["first_line"]), r["n_links"], r["removed"]) for r in line_dedup.judge_lines(docs).collect())
    want = judged_by_hand(rows)
    assert got == want
    gone = sorted(order(r["doc"], i) for r in line_dedup.removed_lines(docs, "doc_id", "text").collect() for i in r["gone"])
    assert gone == [p for p, _, _, late in want if late]


def test_mix_totals(spark, edge):
    sized = edge.withColumn("size", mixing.n_words(F.col("text")))
    rows = mixing.plan(sized).collect()
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert sum(r["mix_taken"] for r in own) == round(own[0]["mix_target"])
        assert all(0 <= r["mix_taken"] <= 3 * r["size"] for r in own)
    assert sum(r["mix_taken"] for r in rows) <= sum(r["size"] for r in rows)


def test_toxicity_tolerates_changes():
    clean = [f"the {a} and the {b} went over plain fields with much grain number {i}. more plain talk here." for i, (a, b) in enumerate(zip("river house garden window table doctor teacher market" .split() * 8, "mountain bridge meadow castle village forest harbor valley".split() * 8, strict=True))]
    toxic = [c.replace("plain", "plain blockhead", 1) for c in clean]
    model = toxicity.train(toxic, clean)
    high = lambda t: model.scores(model.decisions([toxicity.fold(t)]))[0]
    for t in ("you blockhead there", "you b.l.o.c.k.h.e.a.d there", "you b l o c k h e a d there", "you blockxhead there"):
        assert high(t) > high("you river there")
    assert high("you blockhead there") >= 0.5 > high("you river there") and high("") < 0.5


def naive_kernel(a, b):
    """Common subsequences of three characters, by all triples of places."""
    from itertools import combinations

    def weights(u):
        out = {}
        for i, j, k in combinations(range(len(u)), 3):
            if k - i < toxicity.SPAN:
                out[u[i], u[j], u[k]] = out.get((u[i], u[j], u[k]), 0.0) + toxicity.DECAY ** (k - i + 1)
        return out

    x, y = weights(a), weights(b)
    dot = lambda p, q: sum(v * q.get(c, 0.0) for c, v in p.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5 if x and y else 0.0


def test_string_kernel_against_all_triples():
    some = [b"idiot", b"id1ot", b"i.d.i.o.t", b"aaaa", b"abc", b"ab", b"clown", "r\xe9seau".encode("latin-1"), b"worthless" * 5]
    got = toxicity.Landmarks(some).values(some)
    want = np.array([[naive_kernel(a, b) for b in some] for a in some])
    assert np.abs(got - want).max() < 1e-5
    # scores by the table over codes agree with the machine's own values, also for units longer than a table row
    model, values = toxicity.machine(some[:4], some, np.array([1.0, 1, 1] + [0.0] * 6), np.array([0.0] * 3 + [1.0] * 6))
    keep = values > toxicity.FLOOR
    assert np.abs(np.array(model.decide(some))[keep] - values[keep]).max() < 1e-3


def test_toxicity_query_learns_from_labels(spark, tmp_path):
    rng = np.random.default_rng(4)
    plain = [f"word{chr(97 + a)}{chr(97 + b)}" for a in range(12) for b in range(12)]
    say = lambda: " ".join(rng.choice(plain, 8))
    docs = [(k, f"{say()}. {say()} {'you blockhead' if k % 4 == 0 else 'you'} {say()}. {say()}", "s") for k in range(400)] + [(1001, None, "s"), (1002, "", "s"), (1003, "a b.l-o.c.k.h.e.a.d", "s"), (1003, "x" * 50_000, "s")]
    spark.createDataFrame(docs, "doc_id long, text string, score string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = toxicity.query(spark, str(tmp_path)).collect()
    assert len(rows) == len(docs)
    got = {r["doc_id"]: r for r in rows if r["doc_id"] != 1003}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)
    held = [k for k in range(400) if got[k]["held_out"]]
    assert sum(got[k]["predicted"] == (k % 4 == 0) for k in held) >= 0.95 * len(held)
    assert got[1001]["score"] == got[1002]["score"] < 0.5
    assert sorted(r["predicted"] for r in rows if r["doc_id"] == 1003) == [0, 1]


def tables(spark, path, **own):
    for name, df in own.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_media_query_against_the_texts(spark, edge, tmp_path):
    more = edge.unionByName(spark.createDataFrame([(k, ("TAG" * 300)[:k], "s", "clash", "clash", "clash") for k in range(100, 190)], edge.schema))
    want = sorted((r["doc_id"] or 0, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])) for r in more.collect() for raw in [(r["text"] or "").encode()] for p in [media.pad(raw)])
    rows = media.query(spark, tables(spark, tmp_path, documents=more)).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in rows) == want
    for r in rows:
        stored = media.encode(next((x["text"] or "").encode() for x in more.where(F.col("doc_id").eqNullSafe(r["doc_id"])).collect())) if r["doc_id"] in (5, 120) else None
        assert stored is None or (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())


def library(file, end):
    tok = Tokenizer.from_file(public_tokenizers.path(file))
    return lambda text: [*tok.encode(text or "", add_special_tokens=False).ids, end]


def special(spark, edge):
    return edge.unionByName(spark.createDataFrame([(70, "<|endoftext|> x <|startoftext|>", "s", "", "", ""), (71, " lead  and\ttabs ", "s", "", "", "")], edge.schema))


def test_packing_query_against_the_library(spark, edge, tmp_path):
    docs = special(spark, edge)
    ids = library("byte_bpe_50k.json", 0)
    want = {}
    for r in docs.collect():
        want.setdefault(r["doc_id"], []).append(ids(r["text"]))
    pieces, sequences = {}, {}
    for r in packing.query(spark, tables(spark, tmp_path, documents=docs)).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == set(want)
    for doc, own in pieces.items():
        texts = want[doc]  # rows that repeat an id have the same text here
        spots = {}
        for r in own:
            assert r["doc_tokens"] == len(texts[0])
            spots.setdefault(r["start"], []).append((r["length"], r["ids_crc32"]))
            part = np.asarray(texts[0][r["start"] : r["start"] + r["length"]], dtype="<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and len(part) == r["length"]
        assert sum(r["length"] for r in own) == sum(map(len, texts))
        at = np.zeros(len(texts[0]) + 1, dtype=int)
        for r in own:
            at[r["start"]] += 1
            at[r["start"] + r["length"]] -= 1
        assert set(np.cumsum(at)[:-1]) == {len(texts)}  # each id lies in one piece of each of its rows
    for own in sequences.values():
        ends = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == ends
            ends += r["length"]
        assert ends <= 1024


def test_best_fit_takes_the_tightest_window():
    packer = packing.Packer(10, 2)
    piece = lambda d, n: packing.Piece(d, 0, bytes(4 * n), n)
    assert not list(packer.add(piece(1, 6))) and not list(packer.add(piece(2, 5)))
    assert [[(p.doc_id, len(p)) for p in w] for w in packer.add(piece(3, 4))] == [[(1, 6), (3, 4)]]  # 4 are free there, 5 beside
    assert not list(packer.add(piece(4, 7)))
    # none fits: the fullest is filled by a cut and leaves
    assert [[(p.doc_id, p.start, len(p)) for p in w] for w in packer.add(piece(5, 9))] == [[(4, 0, 7), (5, 0, 3)]]


def test_token_query_against_the_library(spark, edge, tmp_path):
    docs = special(spark, edge)
    ids = library("word_bpe_49k.json", 1)
    rows = sorted(token_orc.query(spark, tables(spark, tmp_path, documents=docs)).collect(), key=lambda r: r["start"])
    made = [(r["doc_id"], ids(r["text"])) for r in docs.collect()]
    crc = lambda x: zlib.crc32(np.asarray(x, dtype="<u4").tobytes())
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted((d or 0, len(x), crc(x)) for d, x in made)
    assert [r["doc_id"] or 0 for r in rows] == sorted(d or 0 for d, _ in made)
    assert [r["start"] for r in rows] == [sum(r["n_tokens"] for r in rows[:k]) for k in range(len(rows))]


def test_orc_files_skip_by_metadata(spark, tmp_path):
    from pyarrow import orc

    docs = spark.range(0, 20_000, 2).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), F.col("id").cast("string")).alias("text"))
    path = str(tmp_path / "o")
    token_orc.write_ids(docs.repartition(1), path, public_tokenizers.path("word_bpe_49k.json"))
    found = sorted(tmp_path.glob("o/*.orc"))
    assert sum(orc.ORCFile(str(f)).nrows for f in found) == 10_000
    for f in found:
        file = orc.ORCFile(str(f))
        assert file.row_index_stride == token_orc.ROWS_IN_GROUP and file.nstripes >= 1
        ids = [x for k in range(file.nstripes) for x in file.read_stripe(k, columns=["doc_id"]).column(0).to_pylist()]
        assert ids == sorted(ids)  # stripes are read one by one
    read = token_orc.read_ids(spark, path)
    plan = read.where("doc_id = 4242")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,4242)]" in plan
    # an id that no row has, inside every range: its row groups are told by the Bloom filters
    assert read.where("doc_id = 4242").count() == 1 and read.where("doc_id = 4243").count() == 0


def test_licenses_against_a_plain_search(spark, edge, tmp_path):
    rng = np.random.default_rng(6)
    parts = ["under the MIT license", "Apache License, version 2", "cc-by-nc", "cc by", "the", "ünder", "MIT", "license", "1", "version 2"]
    docs = edge.select("doc_id", "text").unionByName(spark.createDataFrame([(1000 + k, " ".join(rng.choice(parts, rng.integers(1, 40)))) for k in range(60)], "doc_id long, text string"))

    def plain(text):
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        hits = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
        return len(w), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None), ",".join(sorted({x for _, x in hits}))

    key = lambda r: (r["doc_id"] or 0, r["n_words"])
    rows = sorted(licenses.query(spark, tables(spark, tmp_path, documents=docs)).collect(), key=key)
    want = sorted(((r["doc_id"] or 0, *plain(r["text"])) for r in docs.collect()), key=lambda x: x[:2])
    assert [(r["doc_id"] or 0, *(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels"))) for r in rows] == want
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in rows)
    scan = licenses.Scanner().scan
    assert scan(b"SPDX-License-Identifier: MIT\n GNU General Public License")[-1] == 0.8  # a notice beside an identifier counts


def test_bloom_filter_of_many_blocks(spark):
    listed = spark.range(6000).select(F.format_string("h%d.example.net/p%d", "id", F.col("id") % 3).alias("entry"), F.lit("block").alias("verdict"), F.lit(0).alias("tier"))
    urls = [(k, f"http://{'a.b.' * (k % 3)}H{k}.example.net/p{k % 4}/x") for k in range(0, 12_000, 7)]
    pages = spark.createDataFrame([*urls, (-1, "http://" + "x." * 20_000 + "h3.example.net/p0"), (-2, None)], "page_id long, url string").withColumns({"host": F.lit("clash"), "key": F.lit("clash")})
    blocks = url_filter.bloom_blocks(listed, 280)
    assert blocks.count() > 200
    rows = url_filter.judge(pages, listed, ["page_id", "host", "key"]).collect()
    assert rows[0].asDict().keys() == {"page_id", "host", "key", "host_", "path", "rule", "verdict"}
    got = {r["page_id"]: r["verdict"] for r in rows}
    assert got == {**{k: "block" if k < 6000 and k % 4 == k % 3 else "allow" for k, _ in urls}, -1: "block", -2: "allow"}
    # the filter alone lets some pass that the list doesn't hold; the join takes them out
    keys = spark.range(20_000, 60_000).select(F.format_string("h%d.example.net/p0", "id").alias("key"))
    asked = keys.withColumns({"block": url_filter._block(F.col("key"), 280)} | {f"m{i}": m for i, m in enumerate(url_filter._masks(F.col("key")))})
    may = asked.join(blocks, "block")
    for i in range(4):
        may = may.where(F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    assert 0 < may.count() < 4000


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    path = tables(spark, tmp_path, documents=docs, labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"), pages=spark.createDataFrame([], "page_id long, url string, html string"))
    for name, run in queries.QUERIES.items():
        assert run(spark, path).count() == 0, name
    import corpus_pipeline

    assert corpus_pipeline.run(spark, path).count() == 0


def test_quality_stage_against_the_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = quality.stage(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in quality.query(spark, SF).collect() if r["kept"])


def test_mixing_stage_takes_copies_in_order(spark):
    docs = spark.createDataFrame([(k, " ".join(["w"] * (k % 5 + 1)), "abc"[k % 3]) for k in range(90)] + [(900, "", "a"), (901, None, None)], "doc_id long, text string, source string")
    out = mixing.stage(spark, docs, SF)
    assert out.columns == docs.columns
    plan = {r["doc_id"]: r for r in mixing.plan(docs.withColumn("mix_size", mixing.n_words(F.col("text"))), size="mix_size").collect()}
    n = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert n == {d: r["mix_copies"] for d, r in plan.items() if r["mix_copies"]} and 900 not in n and 901 not in n
    spots = {}
    for d, r in plan.items():
        spots.setdefault(d, list(r["mix_positions"][: r["mix_copies"]]))
    order = [r["doc_id"] for r in out.collect()]
    assert len(order) == sum(n.values())


def test_pipeline_end_to_end(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        texts.append({(r["doc_id"], r["text"]) for r in docs.collect()})
    kept, deduped, apart, mixed = texts
    assert {d for d, _ in mixed} <= {d for d, _ in apart} <= {d for d, _ in deduped} <= {d for d, _ in kept}
    # no two of the documents that stay have a similarity of 0.8
    sets = [{" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for _, t in apart for w in [(t or "").lower().split()]]
    assert not any(5 * len(a & b) >= 4 * len(a | b) for i, a in enumerate(sets) for b in sets[i + 1 :])
    ids = library("byte_bpe_50k.json", 0)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert rows.agg(F.sum("length")).first()[0] == sum(len(ids(r["text"])) for r in docs.collect())
    assert corpus_pipeline.run(spark, SF).agg(F.sum("length")).first()[0] == rows.agg(F.sum("length")).first()[0]


def test_edges_keep_rows(spark, edge):
    n = len(EDGE)
    assert quality.judge(edge).count() == n and media.media_columns(edge).count() == n
    assert licenses.license_columns(edge).count() == n
    assert simhash.near_duplicates(edge, ["doc_id", "fp"]).columns == ["doc_id", "fp", "fp_", "component_id"]
    assert toxicity.score(edge, toxicity.Model({}, -0.9, constant=0.1)).count() == n
    assert line_dedup.dedup(edge).columns == edge.columns
    empty = edge.limit(0)
    for f in (line_dedup.judge_lines, lambda d: packing.pack(d, public_tokenizers.path("byte_bpe_50k.json")), lambda d: simhash.near_duplicates(d, ["doc_id"]), lambda d: mixing.plan(d.withColumn("size", mixing.n_words(F.col("text"))))):
        assert f(empty.drop("fp")).count() == 0


def test_near_copies_against_all_pairs(spark):
    words = [f"w{k}" for k in range(3000)]
    base = [" ".join(words[100 * k : 100 * k + 60]) for k in range(8)]
    # one word changed of 60 (51 of 61 shingles shared at worst), chains of such changes, and ten words changed
    edited = [" ".join("new" if k == at else w for k, w in enumerate(x.split())) for x in base for at in (20, 40)]
    chain = [" ".join("new" if k in (20, 21, 22) else w for k, w in enumerate(x.split())) for x in edited[:4]]
    far = [" ".join("far" if k % 6 == 0 else w for k, w in enumerate(x.split())) for x in base]
    texts = [*base, *edited, *chain, *far, base[0].upper(), "short", "short text"]
    docs = [*spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect(), *((800_000 + k, x) for k, x in enumerate(texts))]
    sets = {}
    for d, x in docs:
        w = [v.decode("utf-8", "replace") for v in (x or "").encode().lower().split()]
        sets[d] = {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    out = near_copies.stage(spark, spark.createDataFrame(docs, "doc_id long, text string"), SF)
    assert sorted(r["doc_id"] for r in out.collect()) == [d for d in ids if find(d) == d]
    assert len(ids) - len({find(d) for d in ids}) > len(edited)


@pytest.mark.parametrize("shared", [None, 7])
def test_line_dedup_keeps_rows_of_one_id_apart(spark, shared):
    own = lambda k: f"plain line number {k} about the {k} houses and {k} gardens of town{k} a{k} b{k} c{k} d{k} e{k} f{k}"
    a, b = [own(k) for k in range(6)], [own(k) for k in range(10, 16)]
    rows = [(1, own(30)), (shared, "\n".join(a)), (shared, "\n".join([*b[:5], own(30)])), (shared, "\n".join([own(50), own(51)])), (shared, "\n".join([own(50), own(52)]))]
    rows += [(shared, "\n".join([own(60), own(61)]))] * 2
    out = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = [r["text"] for r in out]
    assert "\n".join(a) in texts and "\n".join(b[:5]) in texts
    got = sorted(x for t in texts for x in t.split("\n"))
    assert got == sorted({x for _, t in rows for x in t.split("\n")})


def test_near_copies_keep_one_row_of_each_group(spark):
    x = " ".join(f"w{k}" for k in range(60))
    y, z = x.replace("w30", "new"), " ".join(f"z{k}" for k in range(60))
    rows = [(5, x, "a"), (5, x, "b"), (5, y, "a"), (9, x, "a"), (None, x, "a"), (None, y, "a"), (None, z, "a"), (None, z, "a"), (None, z + " end", "a"), (None, "alone", "a")]
    out = near_copies.stage(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), SF).collect()
    assert sorted((r["doc_id"] or 0, r["text"][:2]) for r in out) == [(0, "al"), (0, "z0"), (5, "w0")]


def test_long_texts_that_share_a_passage_are_told_apart_by_parities(spark, monkeypatch):
    rng = np.random.default_rng(11)
    passage = " ".join(f"p{k}" for k in range(12))
    texts = [" ".join(f"w{v}" for v in rng.integers(20_000, size=900 + k)) for k in range(30)]
    rows = [(k, f"{t} {passage}") for k, t in enumerate(texts)] + [(100 + k, texts[k] + " end") for k in range(5)]
    compared, sets = [], near_copies.sets
    monkeypatch.setattr(near_copies, "sets", lambda docs, distinct, pairs, ranks: compared.append(pairs.count()) or sets(docs, distinct, pairs, ranks))
    monkeypatch.setattr(near_copies, "CHUNK", 2)
    out = near_copies.stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(r["doc_id"] for r in out.collect()) == list(range(30))
    assert 5 <= sum(compared) < 20  # 435 pairs share the passage


def test_parities_bound_the_distance_of_sets(spark):
    rng = np.random.default_rng(12)
    rows = []
    for n in (1, 30, 120, 128, 129, 500, 2048, 2049):
        own = rng.integers(1 << 62, size=n)
        for cut, new in ((0, 0), (n // 10, 0), (n // 12, n // 12), (0, n // 5)):
            other = np.unique(np.concatenate((own[cut:], rng.integers(1 << 62, size=new)))) if cut + new else own
            rows.append((near_copies.parity(own).tolist(), near_copies.parity(other).tolist(), len(set(own.tolist()) ^ set(other.tolist()))))
    got = spark.createDataFrame(rows, "wide_a array<long>, wide_b array<long>, d long").select(near_copies._apart().alias("least"), "d").collect()
    assert all(r["least"] <= r["d"] for r in got) and any(r["least"] >= 0.8 * r["d"] > 100 for r in got)


def test_ranks_come_to_the_driver_as_one_row(spark, monkeypatch):
    from collections import Counter

    from pyspark.sql.classic.dataframe import DataFrame

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    found = line_dedup.lines(docs, "doc_id", "text", False)
    seen = Counter(w % line_dedup.BUCKETS for r in found.collect() for w in r["toks"])
    monkeypatch.setattr(DataFrame, "toPandas", lambda _: pytest.fail("rows of all buckets in the driver"))
    ranks = spark.range(1).select(line_dedup.rarity(found).alias("r")).first()["r"]
    assert len(ranks) == line_dedup.BUCKETS and len(seen) > 500
    assert all(r == (min(127, 1 + math.floor(4 * math.log2(1 + seen[b]))) if b in seen else 1) for b, r in enumerate(ranks))


def test_settings_of_a_write_end_with_it(spark):
    from lexmill.llm import common

    names = (common._CLEANUP, common._PLAN_TEXT)
    before, writes = [spark.conf.get(x) for x in names], []
    for k in range(common.TIDY + 1):
        writes.append(common.materialise(spark.range(3), f"tidy-{k}").count())
    assert writes == [3] * (common.TIDY + 1) and [spark.conf.get(x) for x in names] == before


def test_lines_meet_in_bands_of_sizes(spark):
    # nested sets match by their sizes alone; the last two only share three words with them
    sizes = [*range(4, 60), 64, 65, 80, 81, 100, 125, 154, 191, 192, 193, 240, 241, 301, 376]
    rows = [(n, " ".join(f"w{k}" for k in range(n))) for n in sizes] + [(1000 + n, " ".join([f"w{k}" for k in range(3)] + [f"x{n}_{k}" for k in range(n)])) for n in (50, 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {d: set(t.split()) for d, t in rows}
    links = {d: [e for e in sets if e != d and 5 * len(s & sets[e]) >= 4 * len(s | sets[e])] for d, s in sets.items()}
    got = {r["doc_id"]: (r["n_links"], r["removed"]) for r in line_dedup.judge_lines(docs).collect()}
    assert got == {d: (len(x), any(e < d for e in x)) for d, x in links.items()} and len(links[192]) == 4


def test_lines_of_far_sizes_do_not_meet(spark, monkeypatch):
    docs = spark.createDataFrame([(n, " ".join(f"w{k}" for k in range(n))) for n in (5, 6, 40)], "doc_id long, text string")
    found, plans = line_dedup.lines(docs, "doc_id", "text", False), []
    keep = line_dedup.materialise
    monkeypatch.setattr(line_dedup, "materialise", lambda df, label, keep_=False: (label == "line-part" and plans.append(df._jdf.queryExecution().optimizedPlan().toString())) or keep(df, label, keep_))
    line_dedup.classes(found, True).collect()
    assert plans and all(re.search(r"Join Inner, .*band", p) for p in plans)
