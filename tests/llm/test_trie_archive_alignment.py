"""Conversation tries, the web archive and token alignment against brute force and round trips."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ticketlake.llm import conversation_trie, oracle, queries, token_alignment, warc_archive
from ticketlake.session import scratch_path

DATA = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BIG = 2**53 + 1


# 11 ---------------------------------------------------------------------------------------
TURNS = "conv_id long, turn long, role string, text string, h1 string, level string, n string"


def brute_nodes(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - c % 20, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    out = set()
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        words = len(p[-1][1].encode().split()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * words
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if built[c] == p)))
        parent = min(members[p[:-1]]) if p else None
        out.add((min(m), len(p), parent, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def nodes_of(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_trie_on_the_table(spark):
    found = nodes_of(queries.op11_conversation_trie(spark, DATA))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/conversations.parquet'")
    rows = con.execute('SELECT conv_id, turn, role, "text" FROM conversations').fetchall()
    assert found == brute_nodes(rows) == set(con.execute(oracle.CONVERSATION_TRIE).fetchall())


def random_turns(seed, convs):
    """Families that share beginnings, copies, few distinct turns."""
    rng, rows, last = random.Random(seed), [], []
    for c in convs:
        if last and rng.random() < 0.6:
            base = rng.choice(last)[: rng.randint(0, 9)]
        else:
            base = []
        turns = base + [(rng.choice("ab"), rng.choice(("x y", "z", "", "w w w"))) for _ in range(rng.randint(0, 4))]
        last.append(turns)
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_of_shared_beginnings(spark, seed):
    rows = random_turns(seed, [*range(0, 120), 200, 405, BIG, BIG + 2])
    frame = spark.createDataFrame([(*r, None, "x", "y") for r in rows], TURNS)
    assert nodes_of(conversation_trie.prefix_nodes(frame)) == brute_nodes(rows)


def test_trie_of_odd_conversations(spark):
    """Nulls, ties, repeated rows, a conversation of one turn that it loses, clashing names."""
    rows = [
        (20, None, None, None), (20, 3, "u", "three"), (20, 3, "u", "three"), (20, 1, "u", None), (20, 2, "", "two"),
        (21, 1, "u", "alone"), (22, 0, "u", "a\tb c\n"), (22, 0, "v", "same turn"), (23, 5, "é", "ß\x1c x\x85y"),
        (None, 1, "u", "nobody's"), (None, None, None, None), (47, 0, "u", "no head"), (BIG, 0, "u", "big"),
    ]
    assert any(zlib.crc32(str(c).encode()) % 4 for c in (21, 47))
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS)
    found = nodes_of(conversation_trie.prefix_nodes(frame))
    # Turns of one number go by their hashes: their order is checked apart from the counts.
    fixed = [r for r in rows if r[0] != 22]
    rest = spark.createDataFrame([(*r, "x", "y", "z") for r in fixed], TURNS)
    assert nodes_of(conversation_trie.prefix_nodes(rest)) == brute_nodes(fixed)
    assert (0 if not found else max(n[3] for n in found)) == len({r[0] for r in rows if r[0] is not None})
    assert not conversation_trie.prefix_nodes(spark.createDataFrame([], TURNS)).collect()


def test_trie_of_long_conversations(spark):
    """Conversations of several segments that part inside, at and after a segment's end."""
    rng = random.Random(3)
    base = [("u", f"w{rng.randrange(50)}") for _ in range(700)]
    rows = []
    for c, keep in ((0, 700), (20, 700), (40, 256), (60, 255), (80, 257), (100, 512), (120, 600), (140, 3)):
        turns = base[:keep] + [("v", f"tail {c}")] * (c % 3)
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS)
    assert nodes_of(conversation_trie.prefix_nodes(frame)) == brute_nodes(rows)


def test_double_array_holds_every_child():
    rng = np.random.default_rng(0)
    trie, edges, layer, next_id = conversation_trie.DoubleArray(8), {}, [0], 0
    for _ in range(5):
        parents, labels = [], []
        for p in layer:
            for label in rng.choice(60, rng.integers(0, 6) or 1, replace=False).tolist():
                parents.append(p)
                labels.append(label)
        places = trie.add(np.array(parents), np.array(labels))
        edges |= {(p, label): t for p, label, t in zip(parents, labels, places.tolist())}
        layer = places.tolist()
    assert len(set(edges.values())) == len(edges) == (trie.check[: trie.end] >= 0).sum() - 1
    p, label = (np.array(x) for x in zip(*edges))
    assert trie.step(p, label).tolist() == list(edges.values())
    with pytest.raises(AssertionError):
        trie.step(np.array([0]), np.array([61]))


# 12 ---------------------------------------------------------------------------------------
PAGES = "page_id long, url string, html string, digest string, warc string, copies string"


def brute_records(rows):
    first = {}
    for page_id, url, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")):
        first.setdefault((html or "").encode(), (page_id, url))
    out, seen = [], set()
    for page_id, url, html in rows:
        payload = (html or "").encode()
        lead = first[payload]
        revisit = len(payload) >= 100 and ((page_id, url) != lead or payload in seen)
        if (page_id, url) == lead:
            seen.add(payload)
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", lead[0] if revisit else None))
    return sorted(out, key=repr)


def odd_pages():
    long, other = "<p>é</p>" * 30_000, "y" * 100
    rows = [
        (5, "http://a/5", long), (3, "http://a/3", long), (9, None, long), (None, "http://a/n", long), (3, "http://a/2", long),
        (7, "http://b", other), (7, "http://b", other), (8, "http://b", other), (BIG, "u", "z" * 99), (BIG + 2, "u", "z" * 99),
        (1, "u\r\nWARC-Type: revisit", None), (2, "u", ""), (None, None, None), (None, None, "q" * 200), (None, None, "q" * 200),
        (11, "http://c?x=é y", "\x00\r\n\r\nWARC/1.1"),
    ]
    return rows


def test_archive_on_the_table(spark):
    found = sorted((tuple(r) for r in queries.op12_warc_archive(spark, DATA).collect()), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{DATA}/pages.parquet'")
    assert found == sorted(con.execute(oracle.WARC_ARCHIVE).fetchall(), key=repr)
    assert found == brute_records(con.execute("SELECT page_id, url, html FROM pages").fetchall())


def parse_records(data):
    """Headers and block of one record, by the format's own rules."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    n = int(fields["Content-Length"])
    assert lines[0] == "WARC/1.1" and rest[n:] == b"\r\n\r\n"
    return fields, rest[:n]


def test_archive_of_odd_pages(spark):
    rows = odd_pages()
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES)
    target = scratch_path(spark, "archive")
    warc_archive.write_archive(frame, target, queries.ARCHIVE_DATE)
    read = warc_archive.read_archive(spark, target)
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[n] for n in names) for r in read.collect()), key=repr) == brute_records(rows)

    # Payloads are stored once.
    stored = spark.read.parquet(f"{target}/payloads").collect()
    assert sorted(bytes(r["payload"]) for r in stored) == sorted({(r[2] or "").encode() for r in rows})

    # Records are whole, and revisits name their response.
    records = [parse_records(bytes(r["record"])) for r in warc_archive.restore(spark, target).collect()]
    assert len(records) == len(rows)
    responses = {f["WARC-Record-ID"]: f for f, _ in records if f["WARC-Type"] == "response"}
    assert len({f["WARC-Record-ID"] for f, _ in records}) == len(rows)
    for fields, block in records:
        http, _, payload = block.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK\r\n")
        if fields["WARC-Type"] == "response":
            assert "sha256:" + hashlib.sha256(payload).hexdigest() == fields["WARC-Payload-Digest"]
        else:
            assert payload == b"" and responses[fields["WARC-Refers-To"]]["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"]

    # And the pages come back.
    clean = lambda u: u and u.replace("\r", "%0D").replace("\n", "%0A")
    back = [(r["page_id"], r["url"], r["html"]) for r in warc_archive.pages(spark, target).collect()]
    assert Counter(back) == Counter((p, clean(u), h or "") for p, u, h in rows)


def test_archive_notices_damage(spark):
    frame = spark.createDataFrame([(1, "u", "x" * 200), (2, "u", "x" * 200), (3, "v", "y")], "page_id long, url string, html string")
    target = scratch_path(spark, "archive")
    warc_archive.write_archive(frame, target, queries.ARCHIVE_DATE)
    damaged = spark.read.parquet(f"{target}/payloads").collect()
    damaged = [(r["digest"], bytes(r["payload"]).replace(b"x", b"z")) for r in damaged]
    spark.createDataFrame(damaged, "digest string, payload binary").write.mode("overwrite").parquet(f"{target}/payloads")
    with pytest.raises(Exception, match="no payload with digest"):
        warc_archive.read_archive(spark, target).collect()


def test_archive_of_nothing(spark):
    target = scratch_path(spark, "archive")
    warc_archive.write_archive(spark.createDataFrame([], PAGES), target, queries.ARCHIVE_DATE)
    assert not warc_archive.read_archive(spark, target).collect()
    assert not warc_archive.restore(spark, target).collect()


# 13 ---------------------------------------------------------------------------------------
ODD_TEXTS = [
    None, "", " ", "  two  blanks ", "plain words, and more: 12.5%", "tab\tand\nnew line \n next", "\n lead", "a\xa0b 　 c d e",
    "é½² Ⅷ 日本語 漢字かな", "😀 family 👨‍👩‍👧", "<s> </s> <unk> <|endoftext|>x<|endoftext|>", "under▁score", "▁", "\x00\x01 \x7f",
    "x" * 3000, "ab " * 3000, "don't we'll I'M  'tis", "line;\r\nnext {\r\n", "\x1c\x1d sep \x1e", "a b" * 2, "﻿bom ​zero", "é nfd ﬁ ｶﾞ",
]


def brute_alignment(rows):
    """Whole texts, every pair of occurrences by comparing ends."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    bytes_a, bytes_b = token_alignment.byte_level_tokens(A), token_alignment.piece_tokens(b)
    docs, counts = [], Counter()
    for doc_id, text in rows:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        parts = [bytes_a[i] for i in ids_a], [bytes_b[i] for i in ids_b]
        if not text or any(b"".join(p) != (" " + text).encode() for p in parts):
            docs.append((doc_id, [], [], "", []))
            continue
        ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        for e in common:
            k, m = ends[0].index(e, i) + 1, ends[1].index(e, j) + 1
            groups.append(",".join(map(str, ids_a[i:k])) + "|" + ",".join(map(str, ids_b[j:m])))
            i, j = k, m
        sides = dict(zip(ends[1], ids_b))
        links = [(x, sides[e]) for x, e in zip(ids_a, ends[0]) if e in sides]
        counts.update(links)
        docs.append((doc_id, ids_a, ids_b, ";".join(groups), links))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for doc_id, ids_a, ids_b, groups, links in docs:
        out.append((
            doc_id, len(ids_a), len(ids_b), groups.count(";") + 1 if groups else 0, len(links),
            hashlib.sha256(groups.encode()).hexdigest() if groups else "",
            sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
        ))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


def alignment_rows(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


def test_alignment_on_the_table(spark):
    con = duckdb.connect()
    rows = con.execute(f"SELECT doc_id, \"text\" FROM '{DATA}/documents.parquet'").fetchall()
    found = alignment_rows(queries.op13_token_alignment(spark, DATA))
    assert found == brute_alignment(rows)
    assert sum(r[1] for r in found)


def test_alignment_of_odd_rows(spark):
    rows = [(i if i % 3 else BIG + 2 * i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "a null id"), (4, "plain words"), (4, "plain words")]
    frame = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "doc_id long, text string, groups string, links string, n_a int")
    found = alignment_rows(token_alignment.alignment_digests(frame, A, B))
    assert found == brute_alignment(rows)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert not token_alignment.alignment_digests(none, A, B).collect()


def test_chunks_encode_as_whole_texts():
    """Random mixes of white space, letters, marks and pieces of other scripts."""
    rng = random.Random(5)
    stuff = [" ", "  ", "\n", "\t", "\r\n", "\xa0", "　", "\x1c", "a", "the", "Straße", "12", ".", ",", "'s", "…", "日本", "é", "é", "😀", "▁", "<s>", "<|endoftext|>", "{", "});", "\x00"]
    texts = ["".join(rng.choice(stuff) for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    aligner = token_alignment.Aligner(A, B)
    for text, (n_a, n_b, _, groups, links) in zip(texts, aligner.align(texts)):
        ids_a = aligner.a.encode(" " + text, add_special_tokens=False).ids
        ids_b = aligner.b.encode(text)
        whole = b"".join(aligner.bytes_b[i] for i in ids_b) == (" " + text).encode()
        got_a = [int(x) for g in groups.split(";") if g for x in g.split("|")[0].split(",")]
        got_b = [int(x) for g in groups.split(";") if g for x in g.split("|")[1].split(",")]
        assert (got_a, got_b) == ((ids_a, ids_b) if whole else ([], [])), text
        assert (n_a, n_b) == (len(got_a), len(got_b))
        codes = np.frombuffer(links, "<u4")
        left, right = aligner.pairs.ids()
        ends = [g.split("|") for g in groups.split(";") if g]
        assert list(zip(left[codes], right[codes])) == [(int(x.split(",")[-1]), int(y.split(",")[-1])) for x, y in ends]


def test_new_chunks_are_learned_few_at_a_time(monkeypatch):
    """Encodings of all new chunks at once took most of a worker's memory."""
    texts = [" ".join(f"w{i}x{k}é" for k in range(9)) + "  " + "long" * i for i in range(6)]
    whole = list(token_alignment.Aligner(A, B).align(texts))
    taken, learn = [], token_alignment.Aligner._learn
    monkeypatch.setattr(token_alignment.Aligner, "_learn", lambda self, c: taken.append(c) or learn(self, c))
    monkeypatch.setattr(token_alignment, "LEARN_CHUNKS", 4)
    monkeypatch.setattr(token_alignment, "LEARN_CHARS", 15)
    aligner = token_alignment.Aligner(A, B)
    assert list(aligner.align(texts)) == whole
    assert max(map(len, taken)) <= 4 and all(len(c) == 1 or sum(map(len, c)) <= 15 for c in taken)
    assert list(aligner.align(texts)) == whole and sum(map(len, taken)) == len(aligner.place)
