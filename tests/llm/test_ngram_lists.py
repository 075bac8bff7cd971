"""Lists of many documents in the n-gram join: pieces, sizes and places, against brute force."""

import random

import numpy as np
import pytest

from paceline.llm import ngram_join
from tests.llm import brute


def letters(count, common, own):
    """Documents that share ``common`` words and have their own ones after them."""
    base = [f"c{k}" for k in range(common)]
    return {d: " ".join([*base, *[f"own{d}x{j}" for j in range(own(d))]]) for d in range(count)}


def mixed_texts():
    """Edited copies of few texts, of many lengths, with passages that all of them share."""
    draw = random.Random(11)
    passage = [f"p{k}" for k in range(30)]
    texts = {}
    for d in range(150):
        family = d % 7
        words = [f"f{family}w{k}" for k in range(25 + 4 * family)] + passage
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = f"e{draw.randrange(60)}"
        texts[d] = " ".join(words[: len(words) - draw.randrange(9)])
    return texts


def groups(spark, texts, **given):
    df = spark.createDataFrame(list(texts.items()), "node long, text string").repartition(4)
    return {r.node: (r.n_shingles, r.component) for r in ngram_join.joined(df, **given).collect()}


@pytest.fixture
def made(monkeypatch):
    """The numbers of pairs that open lists make."""
    counts, real = [], ngram_join.open_pairs

    def counted(*given):
        out = real(*given)
        counts.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "open_pairs", counted)
    return counts


def test_form_letters_make_few_pairs(spark, made):
    """400 letters that share 98 of 106 shingles with each other: no link, and no pair for every two."""
    texts = letters(400, 100, lambda d: 8)
    assert groups(spark, texts) == {d: (106, d) for d in texts}
    assert sum(made) <= 4000


def test_form_letters_of_many_sizes(spark, made):
    texts = letters(200, 100, lambda d: 3 + d % 15)
    assert groups(spark, texts) == brute.groups(texts)
    assert sum(made) <= 200 * 200 / 4


@pytest.mark.parametrize(("piece", "hot", "percent"), [(3, 100_000, 90), (3, 0, 80), (500, 0, 100)])
def test_pieces_lose_no_link(spark, monkeypatch, piece, hot, percent):
    monkeypatch.setattr(ngram_join, "PIECE", piece)
    texts = mixed_texts()
    assert groups(spark, texts, percent=percent, hot=hot) == brute.groups(texts, percent=percent)


def test_light_ngrams_stay_below_heavy_ones_in_full_buckets():
    """Grades tell an n-gram of some hundred documents from buckets of a thousand others, and keep the order of counts."""
    loads = np.random.default_rng(5).poisson(1000, 100_000)
    grades = ngram_join.grade_of(loads, 1000.0)
    assert (ngram_join.grade_of([1500], 1000.0) > grades).all()
    order = np.argsort(loads)
    assert (np.diff(grades[order].astype(int)) >= 0).all()
    assert ngram_join.grade_of([2**40], 0.0) <= 255
