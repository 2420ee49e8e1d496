"""Byte-level BPE against the public library, quality rules against plain loops, and both on odd input."""

import base64
import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from zonecast.llm import bpe, quality_rules

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as f:
        return bpe.Bpe(bpe.parse_ranks(f.read()), public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab eé中\n\t'sS09１²_-.\x1c\x85\xa0　", max_size=60), max_size=4))
def test_ids_equal_the_library(library, codec, texts):
    ids = [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)]
    assert ids == [library.encode_ordinary(t) for t in texts]
    assert [codec.decode(x) for x in codec.encode(texts)] == [t.encode() for t in texts]


def test_a_long_piece(library, codec):
    text = "abracadabra" * 3000 + "a" * 20_000
    assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_digests_of_documents_and_odd_rows(library, documents, odd_docs, no_docs):
    for docs in (documents, odd_docs):
        found = bpe.digests(bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN)).collect()
        expected = []
        for r in docs.collect():
            ids = np.array(library.encode_ordinary(r.text or ""), "<u4")
            sha = hashlib.sha256((r.text or "").encode()).hexdigest()
            expected.append((r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), sha))
        assert Counter(map(tuple, found)) == Counter(expected)
    assert bpe.encode_decode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_rules_on_documents_and_odd_rows(documents, odd_docs, no_docs):
    for docs in (documents, odd_docs):
        found = quality_rules.judge(docs).collect()
        texts = docs.collect()
        got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found)
        assert got == Counter((r.doc_id, *measures(r.text)) for r in texts)
        for r in found:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert r.kept == (not r.base_failed and r.p_good >= 0.5)
    kept = quality_rules.filter_documents(odd_docs)
    assert kept.columns == odd_docs.columns
    assert 13 not in [r.doc_id for r in kept.collect()]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 6, 7, 8, 12, 12]
    assert quality_rules.judge(no_docs).count() == 0


def test_expectation_maximisation_finds_the_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.8
    accuracy = [0.95, 0.9, 0.7]
    votes = np.stack([np.where(rng.random(20_000) < a, truth, ~truth) * 2 - 1 for a in accuracy], axis=1)
    votes[rng.random(votes.shape) < 0.3] = 0
    model = quality_rules.fit(Counter(map(tuple, votes.tolist())), 3)
    assert abs(model.good - 0.8) < 0.1
    for j, a in enumerate(accuracy):
        right = model.given_good[j][1] / (model.given_good[j][1] + model.given_good[j][-1])
        assert abs(right - a) < 0.05
    decided = np.array([model.log_odds(v) >= 0 for v in votes.tolist()])
    assert (decided == truth).mean() > 0.9
