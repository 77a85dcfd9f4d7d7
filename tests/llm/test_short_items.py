"""Short items and unspaced scripts in the benchmark."""

import random

import brute
import pytest

from marketlake.llm import decontaminate


def edited(words, at, kind):
    out = list(words)
    if kind == "replace":
        out[at] = "zzz"
    elif kind == "delete":
        del out[at]
    else:
        out.insert(at, "yyy")
    return out


@pytest.mark.parametrize("size", range(5, 15))
def test_one_edit_anywhere_is_found(size):
    rng = random.Random(size)
    word = lambda: f"w{rng.randrange(300)}"
    item = [f"i{n}" for n in range(size)]
    index = decontaminate.Index([(0, " ".join(item)), (1, " ".join(f"j{n}" for n in range(size)))])
    texts = []
    for at in range(size):
        for kind in ("replace", "delete", "insert"):
            texts.append(" ".join([*(word() for _ in range(rng.randrange(30))), *edited(item, at, kind), *(word() for _ in range(20))]))
    assert [[h["item"] for h in f] for f in index.hits(texts)] == [[0]] * len(texts)


def test_short_items_are_found_up_to_the_limit_and_not_beyond():
    rng = random.Random(3)
    for _ in range(200):
        item = [f"v{rng.randrange(30)}" for _ in range(rng.randrange(1, 15))]
        words = list(item)
        for _ in range(rng.randrange(4)):
            words = edited(words, rng.randrange(len(words)), rng.choice(["replace", "delete", "insert"])) if words else words
        text = [*(f"v{rng.randrange(30)}" for _ in range(12)), *words, *(f"v{rng.randrange(30)}" for _ in range(12))]
        found = next(decontaminate.Index([(0, " ".join(item))]).hits([" ".join(text)]))
        best = brute.edit_distance_within(item, text)
        assert [h["distance"] for h in found] == ([best] if best <= int(len(item) * 0.2 + 1e-9) else [])


def test_words_end_at_unicode_separators():
    text = "caf\u00e9\u00a0noir\u2014\u201cbl\u00e4u\u201d\u3000x_1\uff0cy e\u0301te\u0301 \u0939\u093f\u0928\u094d\u0926\u0940 \u4e2d\u6587abc\u3002"
    got = [w.decode() for w in decontaminate.words_of(text)]
    assert got == ["caf\u00e9", "noir", "bl\u00e4u", "x_1", "y", "e\u0301te\u0301", "\u0939\u093f\u0928\u094d\u0926\u0940", "\u4e2d", "\u6587", "abc"]
    assert [w.decode() for w in decontaminate.words_of(text.replace("\u4e2d\u6587", ""))] == [*got[:7], "abc"]
    assert decontaminate.words_of("Plain_Text, 12-3!") == [b"plain_text", b"12", b"3"]
    assert decontaminate.words_of("\u3002\u2014") == decontaminate.words_of(None) == decontaminate.words_of("\ud800") == []


@pytest.mark.parametrize("first,last", [(0x4e00, 0x5e00), (0x3041, 0x3096), (0x0e01, 0x0e2e)])
@pytest.mark.parametrize("size", [8, 30])
def test_passage_inside_an_unspaced_run(first, last, size):
    rng = random.Random(first + size)
    run = lambda n: "".join(chr(rng.randrange(first, last)) for _ in range(n))
    item = run(size)
    changed = item[:4] + "\u4dbf" + item[5:]
    texts = [run(40) + item + run(40), run(40) + changed + run(40), run(60) + item + "\u3002" + run(9), run(90)]
    found = list(decontaminate.Index([(0, item)]).hits(texts))
    assert [[h["distance"] for h in f] for f in found] == [[0], [1], [0], []]
