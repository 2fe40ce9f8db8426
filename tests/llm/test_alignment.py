"""Token alignment against a plain computation, and its edges."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_DIR

from tallyfield.llm import alignment
from tallyfield.llm.common import scratch
from tallyfield.llm.queries import QUERIES, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = "abctheing'sreABÉß012   \t\n\x1c\x85　▁.!?-_<|>漢😀é’“"


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    byte_level, pieces = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    byte_level.encode_special_tokens = True
    both = alignment.aligner(A, B)

    def tokens(text):
        if not text:
            return [], []
        a, b = byte_level.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        whole = (" " + text).encode()
        same = all(b"".join(known[i] for i in ids) == whole for ids, known in ((a, both.a.bytes), (b, both.b.bytes)))
        return (a, b) if same else ([], [])

    return tokens


def plain(texts, tokens):
    """One dict a text, in order: a loop over bytes, then over all token pairs of each group."""
    both, all_groups, docs_of = alignment.aligner(A, B), [], Counter()
    for text in texts:
        ids = tokens(text)
        ends = [np.cumsum([len(known[i]) for i in x]).tolist() for x, known in zip(ids, (both.a.bytes, both.b.bytes))]
        groups, at, place = [], [0, 0], [{end: i for i, end in enumerate(x)} for x in ends]
        for end in sorted(place[0].keys() & place[1].keys()):
            to = [x[end] + 1 for x in place]
            groups.append((ids[0][at[0] : to[0]], ids[1][at[1] : to[1]]))
            at = to
        all_groups.append((ids, groups))
        docs_of.update({(a, b) for g in groups for a in g[0] for b in g[1]})
    best = defaultdict(int)
    for (a, _), n in docs_of.items():
        best[a] = max(best[a], n)
    for (a_ids, b_ids), groups in all_groups:
        links = [(a, b) for g in groups for a in g[0] for b in g[1]]
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        yield {
            "n_a": len(a_ids), "n_b": len(b_ids), "n_groups": len(groups), "n_links": len(links),
            "n_best": sum(docs_of[p] == best[p[0]] for p in links), "count_sum": sum(docs_of[p] for p in links),
            "groups_sha256": hashlib.sha256(written.encode()).hexdigest() if a_ids else "",
        }


def test_query_is_the_plain_computation(spark, libraries):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    wanted = dict(zip([r["doc_id"] for r in rows], plain([r["text"] for r in rows], libraries)))
    got = QUERIES["op13_token_alignment"](spark, SF_DIR).collect()
    assert len(got) == len(rows)
    for row in got:
        assert wanted[row["doc_id"]].items() <= row.asDict().items()


@pytest.mark.parametrize("block", [1, 300, alignment.BLOCK_TOKENS])
def test_odd_texts_and_small_blocks(spark, libraries, block):
    rng = random.Random(3)
    tail = ["", "", "<|endoftext|>", "<s>", " ", "  ", "\n", " </s> x", "ﬁ", "<0x41>", "x" * 500]
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 40))) + rng.choice(tail) for _ in range(150)]
    texts += [None, "", " ", "same again", "same again", "▁", "漢字" * 3000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    with scratch(spark) as folder:
        got = {r["doc_id"]: r.asDict() for r in alignment.alignment(docs.repartition(3), A, B, folder, block_tokens=block).collect()}
    assert len(got) == len(texts)
    for i, wanted in enumerate(plain(texts, libraries)):
        assert wanted.items() <= got[i].items(), texts[i]
    for row in alignment.token_groups(docs, A, B).collect():
        a, b = libraries(texts[row["doc_id"]])
        assert (row["a_ids"], row["b_ids"]) == (a, b)
        assert sum(row["a_in_group"]) == len(a) and sum(row["b_in_group"]) == len(b)
        assert len(row["a_in_group"]) == got[row["doc_id"]]["n_groups"]


def test_links_of_large_groups_are_unfolded_in_parts(monkeypatch):
    rng = np.random.default_rng(5)
    in_a, in_b = rng.integers(1, 9, (2, 40))
    a, b = rng.integers(0, 5, in_a.sum()), rng.integers(0, 7, in_b.sum())
    groups = alignment.Groups(a, b, in_a, in_b, np.sort(rng.integers(0, 3, 40)))
    whole = alignment.pair_counts(groups)
    monkeypatch.setattr(alignment, "LINKS", 6)
    assert all((x == y).all() for x, y in zip(whole, alignment.pair_counts(groups), strict=True))


@pytest.mark.parametrize("heads", [2, 8])
def test_common_ranks_by_galloping(monkeypatch, heads):
    monkeypatch.setattr(alignment, "HEADS", heads)
    rng = random.Random(4)
    for _ in range(300):
        a, b = (np.unique([*rng.choices(range(2000), k=rng.choice([1, 5, 200, 3000])), 2000]) for _ in range(2))
        both = np.intersect1d(a, b)
        at_a, at_b = alignment.common_ranks(a, b)
        assert a[at_a].tolist() == b[at_b].tolist() == both.tolist()


def test_empty_table_and_rows_without_id(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    with scratch(spark) as folder:
        assert alignment.alignment(docs, A, B, folder).collect() == []
        docs = spark.createDataFrame([(None, "one two"), (None, None), ("a", "one two")], "doc_id string, text string")
        rows = alignment.alignment(docs, A, B, folder + "/more").collect()
    assert sorted(r["n_groups"] for r in rows) == [0, 2, 2] and sum(r["doc_id"] is None for r in rows) == 2
