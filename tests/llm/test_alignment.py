"""Token alignment against brute force over whole texts."""

import hashlib
from collections import Counter, defaultdict

import pytest

from queixa.llm import alignment
from queixa.llm.registry import QUERIES, TOKENIZERS

FILES = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
COLUMNS = "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
TEXTS = [
    None, "", " ", "  two  spaces ", "a", "It's what they'd say: don't!", "<|endoftext|> <s>x</s> <0x41>", "tab\tand\nlines\r\n\n end",
    "naïve café 中文字 emoji 😀 zero\u0000byte no break wide　space ﬁ", "x" * 3000, "12345 67 8.9 a1b2 --- ... !!!", " lead", "trail ",
    "same words here and the same words there", "▁ low line ▁x", "word Word WORD wordword", "a b" * 500 + " tail"]


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(*(open(f, "rb").read() for f in FILES))


def groups_of(pair, text):
    """Token by token: a group ends where the joined bytes of both sides have the same length."""
    if not text:
        return []
    a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    whole = (" " + text).encode()
    if b"".join(pair.bytes_a[i] for i in a) != whole or b"".join(pair.bytes_b[i] for i in b) != whole:
        return []
    spans_a, spans_b = [], []
    for ids, own, spans in ((a, pair.bytes_a, spans_a), (b, pair.bytes_b, spans_b)):
        at = 0
        for i in ids:
            spans.append((at, at + len(own[i]), i))
            at += len(own[i])
    ends = sorted({e for _, e, _ in spans_a} & {e for _, e, _ in spans_b})
    found, start = [], 0
    for end in ends:
        found.append(([x for x in spans_a if start <= x[0] < end], [x for x in spans_b if start <= x[0] < end]))
        start = end
    return found


def brute(pair, rows):
    groups = [groups_of(pair, text) for _, text in rows]
    links = [[(a[2], b[2]) for own_a, own_b in g for a in own_a for b in own_b if a[0] < b[1] and b[0] < a[1]] for g in groups]
    counts = Counter(x for own in links for x in set(own))
    highest = defaultdict(int)
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    out = []
    for (doc_id, _), g, own in zip(rows, groups, links, strict=True):
        text = ";".join(",".join(str(x[2]) for x in a) + "|" + ",".join(str(x[2]) for x in b) for a, b in g)
        out.append((doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(own),
                    sum(counts[x] == highest[x[0]] for x in own), sum(counts[x] for x in own),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


def same(got, expected):
    assert sorted(map(repr, (tuple(r[c] for c in COLUMNS) for r in got))) == sorted(map(repr, expected))


@pytest.mark.parametrize("chunk_bytes", [200, alignment.CHUNK_BYTES])
def test_odd_texts(documents, pair, chunk_bytes):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "without id"), (None, None)]
    same(alignment.align(documents(rows), *FILES, chunk_bytes=chunk_bytes).collect(), brute(pair, rows))


def test_long_text(documents, odd_rows, pair):
    rows = [r for r in odd_rows if r[0] != 8]
    got = {r.doc_id: r for r in alignment.align(documents(rows), *FILES, chunk_bytes=100_000).collect()}
    text = dict(rows)[7]
    assert got[7].n_a == len(pair.a.encode(" " + text, add_special_tokens=False).ids) and got[7].n_b == len(pair.b.encode(text))
    assert got[7].n_links == got[7].n_a + got[7].n_b - got[7].n_groups


def test_whole_table(spark, sf_dir, pair):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    if len(rows) > 1000:
        pytest.skip("the brute force is for small tables")
    groups = [(i, t) for i, t in rows if t is None or len(t) < 6000]
    docs = spark.createDataFrame(groups, "doc_id long, text string")
    same(alignment.align(docs, *FILES, chunk_bytes=50_000).collect(), brute(pair, groups))
    assert QUERIES["op11_identity_map_alignment"](spark, sf_dir).count() == len(rows)


def test_empty_table(documents):
    assert alignment.align(documents([]), *FILES).collect() == []
