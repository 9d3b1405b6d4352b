"""Hard negatives, phrases and archives against brute force."""

import base64
import gzip
import hashlib
import math
import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shroud.llm import negatives, phrases, warc


def negatives_brute(rows, positives=5, n=5, low=80):
    def q(v):
        if not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * x) for x in v]
    rows = [(i, q(v), str(y)) for i, v, y in rows if i is not None and y is not None and q(v) is not None]
    out = []
    for a in sorted({i for i, _, _ in rows if i % 100 == 0}):
        va, ya = min((v, y) for i, v, y in rows if i == a)
        s = [(-sum(x * z for x, z in zip(va, v)), i, y) for i, v, y in rows if i != a and len(v) == len(va)]
        for ps, p, _ in sorted(x for x in s if x[2] == ya)[:positives]:
            hard = sorted(x for x in s if x[2] != ya and low * -ps <= 100 * -x[0] <= 100 * -ps)[:n]
            out += [(a, p, r + 1, i, -ps, -x) for r, (x, i, _) in enumerate(hard)]
    return sorted(out)


@pytest.mark.parametrize("seed,slab,members,clusters", [(1, 1 << 17, 256, 64), (2, 37, 2, 3), (3, 500, 1, 1)])
def test_hard_negatives(spark, seed, slab, members, clusters):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.5, -0.3, 0.0, 0.25, 0.3, 7.9]) + (i % 3) for _ in range(6)], i % 4)
            for i in range(900)]
    rows += [(0, rows[0][1], 1), (7, rows[7][1], 2), (8, rows[7][1], 0), (100, [0.1] * 6, 3)]  # repeats, ties
    rows += [(i, rows[5][1], 0) for i in range(900, 1100)]  # a large group of equal vectors
    rows += [(200, [1.0] * 4, 1), (300, [1.0] * 4, 1), (3, [1.0] * 4, 1), (4, [0.9] * 4, 2), (None, [1.0] * 6, 1),
             (401, None, 1), (402, [], 1), (403, [None] * 6, 1), (404, [float("nan")] * 6, 1),
             (500, [0.0] * 6, 2), (1200, [9.0] * 6, None), (1300, [-1.0] * 6, 7), (1400, [2.0] * 9, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {"slab": F.lit("x"), "anchor": F.lit(1), "id": F.lit(2), "vec": F.lit(3), "rank": F.lit(0)}).repartition(5)
    got = negatives.mine_hard_negatives(spark, df, F.pmod("vec_id", F.lit(100)) == 0, slab=slab,
                                        members=members, clusters=clusters)
    want = negatives_brute(rows)
    assert sorted(map(tuple, got.collect())) == want
    assert len({a for a, *_ in want}) > 5


def test_hard_negatives_number_types_and_small_tables(spark):
    big = [(0, [2.0 ** 16, 1.0], 1), (1, [2.0 ** 16, 3.0], 1), (2, [2.0 ** 16, 2.0], 2), (3, [2.0 ** 16, 3.0], 2),
           (100, [2.0 ** 21, 0.5], 1), (101, [2.0 ** 21 - 2.0 ** -8, 0.5], 2)]
    for rows in (big, big[:2], big[:1], []):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        got = negatives.mine_hard_negatives(spark, df, F.pmod("vec_id", F.lit(100)) == 0)
        assert sorted(map(tuple, got.collect())) == negatives_brute(rows)


def test_walks_stop_early():
    """On grouped vectors a walk reads a fraction of its list."""
    import numpy as np
    rng = np.random.RandomState(0)
    centre = rng.randn(20, 16) * 100
    group = np.arange(8192) % 20
    vectors = np.floor(centre[group] + rng.randn(8192, 16)).astype(np.int64)
    slab = negatives.Slab(np.arange(8192), [str(g) for g in group], vectors)
    read = []

    def admit(score, rows, going, j):
        read.append(len(rows) * len(going))
        return slab.labels[rows][:, None] == slab.labels[:40:20][going][None, :]

    ids, anchors = np.arange(0, 40, 20), vectors[:40:20]
    m, _, r, s = slab.walk(ids, anchors, 1, 5, admit, np.full((2, 1), -negatives.NEVER))
    whole = vectors @ anchors.T
    for i in range(2):
        ok = np.flatnonzero((group == 0) & (np.arange(8192) != ids[i]))
        want = sorted((-whole[x, i], x) for x in ok)[:5]
        assert [(-int(a), int(b)) for a, b in zip(s[m == i], r[m == i])] == [(int(a), int(b)) for a, b in want]
    assert sum(read) < 0.3 * 2 * 8192


# ------------------------------------------------------------------ phrases

def phrases_brute(docs, least=30, longest=4, within=80, first=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    covered = Counter()
    for (lang, w), a in found.items():
        for z in range(2, len(w)):
            for i in range(len(w) - z + 1):
                covered[lang, w[i:i + z]] = max(covered[lang, w[i:i + z]], a)
    by_lang = {}
    for (lang, w), a in found.items():
        if 100 * covered[lang, w] >= within * a:
            continue
        score, k, l, r = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                             for k in range(1, len(w)))
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, rows in by_lang.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(rows)[:first]))


def phrase_docs(seed, n=120):
    rng = random.Random(seed)
    vocab = ["a", "B", "c", "d", "Über", "\u00a0x", "e-f", "(g", "h'", "\x1ci"]
    fixed = ["new york city hall", "a b c d", "x y z", "a a a a a a"]
    docs = []
    for i in range(n):
        parts = [rng.choice([*vocab, *vocab, *fixed, "rare%d" % rng.randrange(400)]) for _ in range(rng.choice([0, 3, 40, 200]))]
        text = "".join(p + rng.choice([" ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b", "?"]) for p in parts)
        docs.append((rng.choice(["en", "en", "en", "de", None, "und"]), text))
    docs += [("en", "same words here again " * 40)] * 30 + [("en", None), (None, ""), ("fr", " .,; "), ("xx", "once")]
    docs += [("en", "long " * 5000), ("en", "one, two; three. " * 3000)]
    return docs


@pytest.mark.parametrize("seed,least,shards,limit", [(1, 30, 4, 8 << 20), (2, 5, 3, 100), (3, 30, 1, 1000)])
def test_phrases(spark, seed, least, shards, limit):
    docs = phrase_docs(seed)
    df = spark.createDataFrame(docs, "lang string, text string").withColumns(
        {"phrase": F.lit("x"), "shard": F.lit(9), "k": F.lit(2), "n": F.lit(3)}).repartition(5)
    # few slots: most phrases share one with others
    got = phrases.mine_collocations(spark, df, least=least, shards=shards, slots=32768, limit=limit, first=40)
    assert sorted(map(tuple, got.collect())) == phrases_brute(docs, least, first=40)


def test_shared_slots_change_no_count(spark, monkeypatch):
    docs = phrase_docs(4, 40)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    monkeypatch.setattr(phrases, "_mix", lambda a, b: a)  # every phrase in the slot of its first word
    got = phrases.mine_collocations(spark, df, least=3, slots=32768)
    assert sorted(map(tuple, got.collect())) == phrases_brute(docs, 3)


def test_phrases_are_activated_late():
    """A phrase is counted only after both its parts have reached the threshold, for one cycle."""
    import numpy as np
    reached = np.full(32768, phrases.UNSET, np.uint8)
    own = phrases.Stretch("en", [b"a b c"])
    assert [k for k, *_ in own.active(reached, 0, 4, 4)] == [1]
    assert list(own.active(reached, 5, 4, 4)) == []
    reached[:] = 0
    assert [k for k, *_ in own.active(reached, 1, 4, 4)] == [1, 2, 3]
    assert [k for k, *_ in own.active(reached, 4, 4, 4)] == [2, 3]
    assert list(own.active(reached, 5, 4, 4)) == []


def test_phrase_whose_parts_share_early_slots_gets_a_whole_cycle():
    """b reaches the threshold at step 1; the slots of "a b" and "b c" were reached at step 0 by other hashes."""
    import numpy as np
    reached = np.full(32768, phrases.UNSET, np.uint8)
    own = phrases.Stretch("en", [b"a b c"])
    slot = lambda h: int(h) & 32767
    (a, b, c), (ab, bc) = own.hash[1:], phrases._mix(own.hash[1:3], own.hash[2:])
    for h, step in ((a, 0), (b, 1), (c, 0), (ab, 0), (bc, 0)):
        reached[slot(h)] = step
    at = [s for s in range(8) if 3 in [k for k, *_ in own.active(np.where(reached < s, reached, phrases.UNSET), s, 2, 3)]]
    assert at == [2, 3]


def test_rare_phrases_among_many_shared_slots(spark):
    rng = random.Random(6)
    vocab = ["w%d" % i for i in range(6000)]
    groups = [" ".join(rng.choices(vocab, k=4)) for _ in range(3000)]
    docs = [("en", ". ".join(rng.choices(groups, k=24))) for _ in range(1000)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    got = phrases.mine_collocations(spark, df, least=6, slots=32768, first=5000)
    assert sorted(map(tuple, got.collect())) == phrases_brute(docs, 6, first=5000)


def test_equal_hashes_that_begin_at_different_steps():
    import numpy as np
    h, act, n = phrases._grouped(np.array([7, 7, 9, 7], np.uint64), np.array([1, 2, 1, 2]))
    assert sorted(zip(h.tolist(), act.tolist(), n.tolist())) == [(7, 1, 1), (7, 2, 2), (9, 1, 1)]


def test_small_phrase_tables(spark):
    for docs in ([], [("en", None)], [(None, "a b " * 40)]):
        df = spark.createDataFrame(docs, "lang string, text string")
        got = phrases.mine_collocations(spark, df)
        assert sorted(map(tuple, got.collect())) == phrases_brute(docs)


def test_scores_beyond_64_bits(spark):
    big = 10 ** 15
    counts = spark.createDataFrame([("en", None, 0, 9 * big), ("en", "a", 1, 5 * big), ("en", "b", 1, 3 * big),
                                    ("en", "a b", 2, 2 * big + 1)], "lang string, phrase string, k int, n long")
    row = phrases.collocations(spark, counts).collect()
    assert [tuple(r) for r in row] == [("en", 1, "a b", 2 * big + 1, 5 * big, 3 * big, 9 * big,
                                        2000000 * (2 * big + 1) // (8 * big))]


# ------------------------------------------------------------------ archives

PAGES = "page_id long, url string, html string"


def pages(seed):
    rng = random.Random(seed)
    hosts = ["http://a.example.com", "https://B.Example.com:443", "http://a.example.com:8080", "ftp://x.org"]
    rows = [(i, f"{rng.choice(hosts)}/p{rng.randrange(40)}", "body %d \u00e9" % rng.randrange(60)) for i in range(300)]
    rows += [(1000 + i, "http://hot.example.com/", "same") for i in range(200)]    # a hot URL and payload
    rows += [(2000, None, "no url"), (2001, None, None), (2002, "http://e.org", ""), (None, "http://n.org/", "nobody"),
             (None, "http://m.org/", "nobody"), (2003, "http://l.org/?q=a b#f", "x" * 3_000_000),
             (2004, "not a url", "\r\n\r\nWARC/1.1\r\n\r\n"), (None, None, "same")]
    return rows


def records_brute(rows):
    out = []
    for i, u, h in rows:
        b = (h or "").encode()
        top = max(((x is not None, x or 0), x) for x, _, y in rows if (y or "") == (h or ""))[1]
        first = min(((v is not None, v or ""), v) for x, v, y in rows if x == top and (y or "") == (h or ""))[1]
        again = (i, u) != (top, first)
        out.append((i, u, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "revisit" if again else "response", top if again else None))
    return sorted(out, key=repr)


def test_archives(spark, scratch):
    rows, root = pages(1), scratch("warc")
    df = spark.createDataFrame(rows, PAGES).withColumns(
        {"key": F.lit("x"), "file": F.lit(1), "again": F.lit(2), "m": F.lit(3), "id": F.lit(4)}).repartition(5)
    captures = warc.write_archives(spark, df, root, most=4000)  # several files a task
    index = warc.build_index(spark, captures, root, files=3, block=7)
    found = warc.lookup(spark, root, index, df)
    got = warc.read_records(spark, root, found)
    said = [(int(r.id) if r.id else None, r.url, r.payload_bytes, r.payload_digest, r.type,
             int(r.refers_to) if r.refers_to else None) for r in got.collect()]
    assert sorted(said, key=repr) == records_brute(rows)
    by_id = {(i, u): (h or "").encode() for i, u, h in rows}
    for r in got.where("type = 'response'").collect():
        assert bytes(r.payload) == by_id[int(r.id) if r.id else None, r.url]
    # some URLs, a URL that is not there, one that has the key of another
    asked = spark.createDataFrame([("http://a.example.com/p1",), ("http://hot.example.com/",), ("http://no.org/",),
                                   ("http://A.example.com:80/p1#x",)] * 2, "url string")
    want = [u for _, u, _ in rows if u in ("http://a.example.com/p1", "http://hot.example.com/")]
    assert sorted(r.url for r in warc.lookup(spark, root, index, asked).collect()) == sorted(want)
    by_key = warc.lookup(spark, root, index, asked, by_key=True)
    assert sorted(r.url for r in by_key.collect()) == sorted(want)


def test_archive_files_are_plain_warc(spark, tmp_path):
    """Every file is a chain of gzip members, one a record; what lost tasks left is removed."""
    rows, root = pages(2)[:50], str(tmp_path)
    os.makedirs(f"{root}/data")
    open(f"{root}/data/part-lost.warc.gz", "wb").write(b"half a rec")
    captures = warc.write_archives(spark, spark.createDataFrame(rows, PAGES), root)
    names = {r.file for r in captures.collect()}
    assert set(os.listdir(f"{root}/data")) == names
    whole = b"".join(gzip.decompress(open(f"{root}/data/{n}", "rb").read()) for n in names)
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows)


def test_index_reads_few_blocks(tmp_path, spark):
    root = str(tmp_path)
    rows = [(f"k{i:05}", str(i), f"u{i}", "d", "response", "x", "f", i, 1) for i in range(5000)]
    index = warc.build_index(spark, spark.createDataFrame(rows, warc.CAPTURE), root, files=1, block=100).collect()
    assert [(r["first"], r["last"], r["rows"], r["blocks"]) for r in index] == [("k00000", "k04999", 5000, 50)]
    from pyarrow import fs
    f = warc._IndexFile(fs.LocalFileSystem(), f"{root}/index/{index[0].file}")
    for i in (0, 99, 100, 101, 4999):
        f.reads = 0
        assert [r[2] for r in f.find(f"k{i:05}")] == [f"u{i}"] and f.reads <= 2
    assert list(f.find("k")) == [] and list(f.find("z")) == []


def test_damaged_records_are_refused():
    raw = warc.record("1", "http://a.org/", b"payload", "1970-01-01T00:00:00Z")
    assert warc.parse(raw)["payload"] == b"payload"
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(raw.replace(b"payload\r\n", b"paYload\r\n"))


@pytest.mark.parametrize("url,key", [
    ("http://www.Example.com:80/a?b=C#d", "com,example,www)/a?b=C"), ("https://u:p@x.org", "org,x)/"),
    ("http://x.org:8080/", "org,x:8080)/"), ("http://[::1]:80/x", "[::1])/x"), ("mailto:a@b", "mailto:a@b"), (None, "")])
def test_url_keys(url, key):
    assert warc.url_key(url) == key


def test_empty_archive(spark, scratch):
    root = scratch("warc")
    df = spark.createDataFrame([], PAGES)
    index = warc.build_index(spark, warc.write_archives(spark, df, root), root)
    found = warc.lookup(spark, root, index, df)
    assert warc.read_records(spark, root, found).collect() == []
