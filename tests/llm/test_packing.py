import json
import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from viewer_insights.llm import packing as p


def test_ids_equal_the_tokenizer_on_whole_texts():
    rng = random.Random(2)
    parts = ["hello", "World", "it's", " ", "  ", "\n", "\t", "\x1c", "é", "e\u0301", "\u0301", "Σας", "ΣΑΣ", "<|endoftext|>", "12", "\u00a0", "...", "日本", "\u200b",
             "'s", "'", "İ", "<|ENDOFTEXT|>", "###", "a.b", "ñandú,", "1²", "ß", "_", "<", "|>", "don't.", "...x"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(600)]
    texts += [t.replace("\x1c", "").replace("İ", "") for t in texts]
    data = open(p.TOKENIZER, "rb").read()
    plain = Tokenizer.from_buffer(data)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for cache in (10**6, 5):
        tokens = p.WordTokens(data, cache)
        got = [x.tolist() for i in range(0, len(texts), 50) for x in tokens.encode(texts[i:i + 50])]
        assert got == want


def test_vocabularies_prepared_otherwise_get_whole_texts():
    plain = json.loads(open(p.TOKENIZER, "rb").read())
    assert p.WordTokens(json.dumps(plain).encode()).by_word
    texts = ["Hello hello, World", "IT'S a.b 12", "x  y\n Z"]
    cased = plain | {"normalizer": {"type": "Sequence", "normalizers": plain["normalizer"]["normalizers"][:2]}}
    joined = plain | {"pre_tokenizer": {"type": "Sequence", "pretokenizers": plain["pre_tokenizer"]["pretokenizers"][1:]}}
    bare = plain | {"normalizer": None, "pre_tokenizer": None}
    for how in (cased, joined, bare):
        data = json.dumps(how).encode()
        tokens, whole = p.WordTokens(data), Tokenizer.from_buffer(data)
        assert not tokens.by_word
        assert [x.tolist() for x in tokens.encode(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def slow_sum_of_squares(lengths, capacity):
    gaps = []
    for s in lengths:
        def total(g):
            return sum(g.count(x) ** 2 for x in set(g) if x)

        options = [(total([*gaps[:i], g - s, *gaps[i + 1:]]), 0, g, i) for i, g in enumerate(gaps) if g >= s]
        options.append((total([*gaps, capacity - s]), 1, 0, None))
        best = min(options, key=lambda o: o[:3])
        if best[3] is None:
            gaps.append(capacity - s)
        else:
            gaps[best[3]] -= s
    return sorted(gaps)


def test_rule_equals_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        cap = rng.randint(3, 15)
        lengths = [rng.randint(1, cap) for _ in range(rng.randint(0, 25))]
        bins, _ = p.sum_of_squares(np.array(lengths, np.int64), cap)
        fill = np.bincount(bins, lengths, int(bins.max()) + 1 if len(bins) else 0)
        assert sorted(cap - fill) == slow_sum_of_squares(lengths, cap)


def test_pack_is_valid_and_close_to_the_least():
    rng = np.random.default_rng(1)
    lengths = np.minimum(2047, rng.lognormal(6, 1, 20_000).astype(np.int64) + 1)
    bins, offsets = p.pack(lengths, 2048)
    order = np.lexsort((offsets, bins))
    b, o, n = bins[order], offsets[order], lengths[order]
    first = np.append(True, b[1:] != b[:-1])
    assert (o[first] == 0).all() and (o[~first] == (o + n)[:-1][~first[1:]]).all() and (o + n).max() <= 2048
    assert len(set(b.tolist())) == b.max() + 1 <= 1.003 * lengths.sum() / 2048 + 1


def test_pieces_cover_documents_and_sequences(docs, odd):
    rows = [*odd, *((100 + i, "token " * (i * 37 % 900)) for i in range(80)), (500, "a " * 2047), (501, "a " * 2048), (502, "a " * 5000)]
    plain = Tokenizer.from_file(p.TOKENIZER)
    want = sorted((str(i), *(x for x in plain.encode(t or "", add_special_tokens=False).ids), 0) for i, t in rows)
    for group_rows in (p.GROUP_ROWS, 20):
        got = p.pack_documents(docs(rows), group_rows=group_rows).collect()
        expect = []
        for doc in want:
            ids = np.array(doc[1:], "<u4")
            expect += [(doc[0], k, a, len(ids[a:a + 2048]), zlib.crc32(ids[a:a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]
        assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(expect)
        seqs = {}
        for r in got:
            seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for s in seqs.values():
            s.sort()
            assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and sum(n for _, n in s) <= 2048
        again = p.pack_documents(docs(rows, 5), group_rows=p.GROUP_ROWS).collect()
    assert sorted(map(str, again)) != [] and len(again) == len(got)


def test_empty_table(docs):
    assert p.pack_documents(docs([])).collect() == []
