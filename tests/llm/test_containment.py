"""Containment search against counting every shingle of every item in every document."""

import random

from stratiform.llm.common import WordHashes, shingles, words
from stratiform.llm.containment import ItemIndex, contained_items


def shingle_set(text, size=5):
    w = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(docs, items, threshold=0.8):
    found = set()
    for doc_id, text in docs:
        own = shingle_set(text)
        for item_id, item in items:
            wanted = shingle_set(item)
            if wanted and len(wanted & own) >= threshold * len(wanted) - 1e-9:
                found.add((doc_id, item_id, len(wanted & own), len(wanted)))
    return found


def got(spark, docs, items, **options):
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = contained_items(documents, benchmark, **options).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert all(abs(i["containment"] - i["shared"] / i["item_shingles"]) < 1e-12 for i in r["items"])
    return {(r["doc_id"], i["item_id"], i["shared"], i["item_shingles"]) for r in rows for i in r["items"]}


def planted(seed=3):
    rng = random.Random(seed)

    def text(n):
        return [f"w{rng.randrange(400)}" for _ in range(n)]

    items = [(i, " ".join(text(n))) for i, n in enumerate([5, 6, 9, 14, 20, 33, 47, 60, 130, 300])]
    docs = []
    for doc_id in range(60):
        body = text(rng.choice([10, 60, 500, 4000]))
        for _ in range(rng.choice([0, 1, 1, 2])):
            passage = items[rng.randrange(len(items))][1].split()
            kind = rng.randrange(4)
            if kind == 1:  # some words changed
                for _ in range(rng.randrange(1, 4)):
                    passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(body))
            if kind == 2:  # in two places
                cut = len(passage) // 2
                body[at:at] = passage[:cut]
                body[len(body) - at : len(body) - at] = passage[cut:]
            elif kind == 3:  # only a part
                body[at:at] = passage[: rng.randrange(1, len(passage) + 1)]
            else:
                body[at:at] = passage
        docs.append((doc_id, " ".join(body).title() + "."))
    return docs, items


def test_equals_brute_force(spark):
    docs, items = planted()
    expected = brute(docs, items)
    assert len(expected) > 15
    assert got(spark, docs, items) == expected
    # Items in several blocks, few words at a time.
    assert got(spark, docs, items, block_chars=900, words_at_once=300) == expected


def test_odd_rows(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, None), (2, ""), (3, "--"), (4, item), (4, item), (None, item), (5, "x " * 50_000 + item), (6, "alpha beta"), (7, "beta")]
    items = [(1, item), (1, item), (2, None), (3, ""), (4, "Alpha, beta!"), (None, item)]
    assert got(spark, docs, items) == brute(docs, [i for i in items if i[1]])
    assert got(spark, docs, []) == set() and got(spark, [], items) == set()


def test_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 9, "x")], "doc_id long, text string, items int, shared string")
    items = spark.createDataFrame([(7, "a b c d e f", 1)], "item_id long, text string, doc_id int")
    rows = contained_items(docs, items).collect()
    assert rows[0].asDict(recursive=True) == {
        "doc_id": 1, "text": "a b c d e f", "shared": "x",
        "items": [{"item_id": 7, "containment": 1.0, "shared": 2, "item_shingles": 2}],
    }


def test_tiny_items_are_never_missed():
    """Items of one to three shingles in documents of many; by windows some in a thousand were missed."""
    items = [(i, " ".join(f"q{i}w{k}" for k in range(5 + i % 3))) for i in range(6000)]
    index = ItemIndex(items, 5, 64, 0.8)
    hashed = WordHashes()
    texts = [shingles(hashed(words(" ".join([*[f"d{i}a{k}" for k in range(60)], text, *[f"d{i}b{k}" for k in range(60)]]))), 5) for i, text in items]
    found = [own for low in range(0, len(texts), 500) for own in index.search(texts[low : low + 500])]
    assert [[f[0] for f in own] for own in found] == [[i] for i, _ in items]
