import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm.cases import frame, odd_rows
from conftest import rows
from shopgrain.llm import alignment as A
from shopgrain.llm.bpe import Tables, byte_letters

PATH_A = public_tokenizers.path("byte_bpe_50k.json")
PATH_B = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    " double  spaces   and trailing  ", " ", "  ", "a", "\t\n x", "▁ lower block", "tab\tend ",
    "<|endoftext|> <s> </s> <unk>", "größe évier año 河川 😀😀 　 \xa0 ﬁ ſ", "x" * 700, "0123456789" * 30,
    "uń é", "\u0000 nul", "the\r\nline  \r\n\r\n   end", "河川河川河川" * 20, "a " * 300]


@pytest.fixture(scope="module")
def tokenizers():
    one = Tokenizer.from_file(PATH_A)
    one.encode_special_tokens = True
    one.no_truncation()
    one.no_padding()
    return one, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def tokens(text, tokenizers):
    """(ids, bytes) of A and of B by the libraries; none where the bytes differ."""
    if not text:
        return [], []
    one, two = tokenizers
    letters = byte_letters()
    a = [(i, bytes(letters[c] for c in one.id_to_token(i)))
         for i in one.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode())
         for i in two.encode(text) for p in [two.id_to_piece(i)]]
    raw = (" " + text).encode()
    return (a, b) if all(b"".join(x for _, x in t) == raw for t in (a, b)) else ([], [])


def brute(texts, tokenizers):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups."""
    coded = [tokens(t, tokenizers) for t in texts]
    linked, grouped = [], []
    for a, b in coded:
        spans = [np.cumsum([0] + [len(x) for _, x in side]).tolist() for side in (a, b)]
        linked.append([(a[i][0], b[j][0]) for i in range(len(a)) for j in range(len(b))
                       if spans[0][i] < spans[1][j + 1] and spans[1][j] < spans[0][i + 1]])
        common = sorted(set(spans[0]) & set(spans[1]))
        grouped.append([tuple(",".join(str(side[k][0]) for k in range(len(side))
                                       if lo <= at[k] < hi) for side, at in zip((a, b), spans))
                        for lo, hi in zip(common, common[1:])])
    total = Counter(p for links in linked for p in links)
    highest = {}
    for (_, b), n in total.items():
        highest[b] = max(n, highest.get(b, 0))
    return [(len(a), len(b), len(g), len(k), sum(total[p] == highest[p[1]] for p in k),
             sum(total[p] for p in k), ";".join("|".join(x) for x in g))
            for (a, b), g, k in zip(coded, grouped, linked)]


def test_ends():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 300, 5000):
        for share in (0.02, 0.5, 0.95):
            both = np.cumsum(rng.integers(1, 4, n))
            x, y = (np.union1d(both[rng.random(n) < share], both[-1]) for _ in range(2))
            for lane in (16, 100, 10**6):
                cut_x, cut_y = A.align_ends(x, y, lane)
                common = np.intersect1d(x, y)
                assert (x[cut_x] == common).all() and (y[cut_y] == common).all()
            i, j = A.links(x, y, cut_x, cut_y)
            begin_x, begin_y = np.append(0, x[:-1]), np.append(0, y[:-1])
            want = [(a, b) for a in range(len(x)) for b in range(len(y))
                    if begin_x[a] < y[b] and begin_y[b] < x[a]] if n < 500 else list(zip(i, j))
            assert list(zip(i, j)) == want


def test_pieces_are_those_of_whole_texts(tokenizers):
    with open(PATH_B, "rb") as f:
        coder = A.Pieces(f.read())
    rng = random.Random(2)
    texts = TEXTS + [t for _, t, *_ in odd_rows() if t] + [
        "".join(rng.choice("ab  \n.é河1") for _ in range(rng.randrange(60))) for _ in range(500)]
    for text, ids in zip(texts, coder.encode([" " + t for t in texts])):
        assert not text or ids.tolist() == tokenizers[1].encode(text), text


def test_against_brute_force(spark, tokenizers):
    texts = TEXTS + [t and t[:3000] for _, t, *_ in odd_rows()] + [TEXTS[0]] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    want = brute(texts, tokenizers)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    for block_links in (50, A.BLOCK_LINKS):
        got = A.align(df, PATH_A, PATH_B, block_links=block_links)
        assert got.columns == ["doc_id", "text", *names]
        found = {r["doc_id"]: tuple(r[n] for n in names) for r in got.collect()}
        for k, text in enumerate(texts):
            assert found[k] == want[k], text
    # Only characters that one side rewrites leave a text without tokens.
    assert {texts[k] for k, w in enumerate(want) if not w[0]} >= {None, "", "▁ lower block"}


def test_digest_and_kept_columns(spark):
    from pyspark.sql import functions as F

    df = frame(spark)
    whole = A.align(df, PATH_A, PATH_B)
    short = A.align(df, PATH_A, PATH_B, keep=["doc_id"], store=lambda g: F.sha2(g, 256))
    digest = [(r["doc_id"], r["count_sum"], hashlib.sha256(r["groups"].encode()).hexdigest())
              for r in whole.collect()]
    assert sorted(digest, key=str) == sorted(
        [(r["doc_id"], r["count_sum"], r["groups"]) for r in short.collect()], key=str)


def test_odd_columns(spark):
    odd = frame(spark)
    clash = odd.selectExpr("*", "1 AS block", "'x' AS row", "text AS body", "2 AS code", "3 AS n_a",
                           "4 AS counts", "5 AS `a.b`", "6 AS total")
    got = A.align(clash, PATH_A, PATH_B)
    kept = [c for c in clash.columns if c != "n_a"]
    quoted = [f"`{c}`" for c in kept]
    assert rows(got.select(*quoted)) == rows(clash.select(*quoted))
    plain = A.align(odd, PATH_A, PATH_B)
    assert rows(got.select("doc_id", "n_a", "groups")) == rows(plain.select("doc_id", "n_a", "groups"))
    assert A.align(odd.limit(0), PATH_A, PATH_B).count() == 0


def test_tables_give_bytes():
    tables = Tables.read(PATH_A)
    assert sorted(p[0] for p in tables.pieces if len(p) == 1) == list(range(256))


def test_words_are_cut_once_for_both_sides(tokenizers):
    with open(PATH_B, "rb") as f:
        pair = A.Pair(Tables.read(PATH_A), f.read())
    rng = random.Random(4)
    texts = TEXTS + [None, "", "a \n  b", "c\n   ", "d\x85 \t e"] + [
        "".join(rng.choice("ab  \n\t.é河1'\xa0▁　\x1c") for _ in range(rng.randrange(40))) for _ in range(500)]
    asked = []
    for side in (pair.one, pair.two):
        side.findall = lambda text, cut=side.findall: asked.append(text) or cut(text)
    for again in range(2):
        flat, bounds = pair.encode_both(texts)
        for k, text in enumerate(texts):
            want = [[i for i, _ in side] for side in tokens(text, tokenizers)]
            assert [x[b[k]:b[k + 1]].tolist() for x, b in zip(flat, bounds)] == want, text
        # Known words are not cut again, by neither side.
        assert again or asked
        assert not again or not asked
        asked.clear()
