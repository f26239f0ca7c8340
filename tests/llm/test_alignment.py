"""Token alignment against a plain version, and the fast encoder against the file's own."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from grainmill.llm import alignment

SCHEMA = "doc_id long, text string, n_a string, chunk int"
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def plain():
    slow = Tokenizer.from_file(alignment.A_PATH)
    slow.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=alignment.B_PATH)
    signs = alignment._byte_signs()

    def b_bytes(i):
        return bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return None
        a = [(i, bytes(signs[c] for c in slow.id_to_token(i))) for i in slow.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, b_bytes(i)) for i in pieces.encode(text)]
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else None

    def spans(side):
        at, out = 0, []
        for i, x in side:
            out.append((at, at + len(x), i))
            at += len(x)
        return out

    def run(docs):
        rows, corpus = [], Counter()
        for doc_id, text in docs:
            sides = tokens(text)
            if sides is None:
                rows.append((doc_id, 0, 0, 0, None, ""))
                continue
            a, b = map(spans, sides)
            links = []
            j0 = 0
            for s, e, i in a:
                while b[j0][1] <= s:
                    j0 += 1
                j = j0
                while j < len(b) and b[j][0] < e:
                    links.append((i, b[j][2]))
                    j += 1
            corpus.update(links)
            cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
            groups, start = [], 0
            for c in cuts:
                groups.append("|".join(",".join(str(i) for s, _, i in side if start <= s < c) for side in (a, b)))
                start = c
            rows.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        best = {}
        for (_, b), n in corpus.items():
            best[b] = max(best.get(b, 0), n)
        out = []
        for doc_id, n_a, n_b, n_groups, links, digest in rows:
            links = links or []
            out.append((doc_id, n_a, n_b, n_groups, len(links), sum(corpus[x] == best[x[1]] for x in links), sum(corpus[x] for x in links), digest))
        return sorted(out, key=str), corpus

    return run


def test_documents(spark, plain):
    rng = random.Random(2)
    words = ["the", "Quantität", "internationalisation", "ёлка", "12345", "don't", "  ", "\n\n", "<s>", "<|endoftext|>", "日本", "🙂", "x", "é", "\t", "<0x41>"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for i in range(120)]
    docs += [(200, None), (201, ""), (202, " "), (203, "a▁b"), (204, "the " * 20_000), (205, "y" * 3000), (None, "no id"), (5, docs[5][1]), (5, docs[5][1]), (206, "\x00\x7f é")]
    table = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], SCHEMA).repartition(5)
    want, corpus = plain(docs)
    for chunk_bytes in (300, alignment.CHUNK_BYTES):
        done = alignment.aligned(table, chunk_bytes=chunk_bytes)
        assert sorted((tuple(r[c] for c in COLUMNS) for r in done.scored().collect()), key=str) == want
        assert {(r.a, r.b): r.n for r in done.pair_counts().collect()} == dict(corpus)


def test_given_documents(spark, plain):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = alignment.alignments(spark.createDataFrame([(i, t, "", 0) for i, t in docs], SCHEMA))
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=str) == plain(docs)[0]


def test_identity_map_and_regular_share(spark):
    v = alignment.vocabularies(alignment.A_PATH, alignment.B_PATH)
    for a in range(0, len(v.same), 97):
        if v.same[a] >= 0:
            assert v.a.bytes_of[a] == v.b.bytes_of[v.same[a]] and not (v.b.as_byte[v.same[a]] and v.a.bytes_of[a] in v.b.bytes_of[259:])
    links = alignment.linked(["a plain text of common words"], v)
    assert links.regular.mean() > 0.8


def test_encoder_of_ranks_equals_the_file(spark):
    slow = Tokenizer.from_file(alignment.A_PATH)
    slow.encode_special_tokens = True
    fast = alignment.ByteLevel(alignment.A_PATH)
    rng = random.Random(1)
    pool = [chr(c) for r in ((0, 0x250), (0x370, 0x530), (0x3040, 0x3100), (0x1F600, 0x1F650)) for c in range(*r)] + list("  \n\t'sdt")
    texts = [" " + "".join(rng.choice(pool) for _ in range(200)) for _ in range(300)]
    assert fast.encode(texts) == [slow.encode(t, add_special_tokens=False).ids for t in texts]


def test_empty_table(spark):
    assert alignment.alignments(spark.createDataFrame([], SCHEMA)).collect() == []
