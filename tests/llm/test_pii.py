"""Surrogates: consistent, distinct, of the same format; collisions; nothing else is touched."""

import re

import pytest

from stratiform.llm import pii_surrogates
from stratiform.llm.pii_entities import GIVEN, Entity, Surrogates, canonical, digits, find_entities, luhn
from stratiform.llm.pii_surrogates import replace_personal_data, surrogate_table

FOLDER = "/root/testdata/sf0.01"
S = Surrogates(b"test")


def kinds(text):
    return [(e.kind, text[e.start : e.end]) for e in find_entities(text)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("ask a.b-1@mail.example.com.", [("email", "a.b-1@mail.example.com")]),
        ("call +1 (017) 555-7713, 017-555-7713", [("phone", "+1 (017) 555-7713"), ("phone", "017-555-7713")]),
        ("at 97.51.17.173. or 1.2.3.4.5 or 300.1.1.1", [("ip", "97.51.17.173")]),
        ("4111 1111 1111 1111 9807915762804490", [("card", "4111 1111 1111 1111"), ("card", "9807915762804490")]),
        ("575569573 and 078-05-1120", [("number", "575569573"), ("number", "078-05-1120")]),
        ("Frau Özdemir met Mary Stone; Stone left", [("name", "Özdemir"), ("name", "Mary"), ("name", "Stone"), ("name", "Stone")]),
        ("2020-05-06 12:30 v1.2 1234.5678 deadbeef123456789", []),
        ("Mary had a lamb. mr smith", []),
    ],
)
def test_what_is_found(text, expected):
    assert kinds(text) == expected


def test_permutations_are_bijective():
    for size in (1, 2, 3, 10, 257, 1000):
        assert sorted(S.permuted(i, size, "t") for i in range(size)) == list(range(size))


def test_formats_stay():
    text = "+1 (017) 555-7713"
    own = S.written(find_entities(text)[0], text)
    assert own != text and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", own)
    for card in ("4111111111111111", "9807915762804490"):
        own = S.of("card", card)
        assert luhn(own) == luhn(card) and own[0] == card[0] and len(own) == len(card)
    for (script, gender), names in GIVEN.items():
        assert sorted(S.of("name", n.lower(), gender) for n in names) == sorted(n.lower() for n in names)
    assert S.of("name", "петров")[0] in "бвгджзклмнпрстфх"
    iban = S.of("iban", "DE89370400440532013000")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def test_mentions_of_one_entity_agree():
    text = "+1 (017) 555-7713 017-555-7713 A@b.com a@B.COM 4111-1111-1111-1111 4111111111111111 Mr. Stone STONE stone"
    new = [S.written(e, text[e.start : e.end]) for e in find_entities(text)]
    assert digits(new[0])[1:] == digits(new[1]) and new[2].lower() == new[3].lower() and digits(new[4]) == digits(new[5])
    assert new[2][0].isupper() and new[3][0].islower()


@pytest.fixture(scope="module")
def cleaned(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return {r["doc_id"]: r["text"] for r in docs.collect()}, replace_personal_data(docs).collect()


def test_whole_table(cleaned):
    texts, rows = cleaned
    assert len(rows) == len(texts)
    by_original, by_surrogate, count = {}, {}, 0
    for r in rows:
        before, entities = texts[r["doc_id"]], find_entities(texts[r["doc_id"]])
        assert [(e.kind, e.start, e.end) for e in entities] == [(f["kind"], f["start"], f["end"]) for f in r["replaced"]]
        after, at = [], 0
        for e, f in zip(entities, r["replaced"]):
            after += [before[at : e.start], f["surrogate"]]
            at = e.end
            new = canonical(e.kind, f["surrogate"])
            assert by_original.setdefault((e.kind, e.canonical), new) == new
            assert by_surrogate.setdefault((e.kind, new), e.canonical) == e.canonical
            count += 1
        assert r["text"] == "".join([*after, before[at:]])
        assert entities or r["text"] == before
    originals = set(by_original)
    assert count > 50 and not any((kind, new) in originals for (kind, _), new in by_original.items())


def test_collisions_are_resolved(spark, monkeypatch):
    """Surrogates from so small a space that originals meet each other's; all end up distinct."""

    def narrow(self, kind, text, gender="", attempt=0):
        return f"n{(int(text[1:]) * 7 + attempt * 5) % 50 + (0 if attempt < 2 else 40 * attempt)}"

    monkeypatch.setattr(Surrogates, "of", narrow)
    mentions = spark.createDataFrame([("x", f"n{i}") for i in range(0, 100, 4)], "kind string, canonical string")
    # Python workers do not see the patch, so the table is built where this process can.
    maker = Surrogates(b"k")

    def here(entities, key):
        rows = [(r["kind"], r["canonical"], r["attempt"], maker.of(r["kind"], r["canonical"], attempt=r["attempt"])) for r in entities.collect()]
        return spark.createDataFrame(rows, "kind string, canonical string, attempt int, surrogate string")

    monkeypatch.setattr(pii_surrogates, "_with_surrogates", here)
    rows = surrogate_table(mentions, b"k").collect()
    made = [r["surrogate"] for r in rows]
    assert len(rows) == 25 and len(set(made)) == 25 and not set(made) & {r["canonical"] for r in rows}
    assert any(r["attempt"] for r in rows)


@pytest.mark.parametrize("few", [100_000, 0])
def test_retried_originals_reach_their_documents(spark, monkeypatch, few):
    """One-letter addresses: 25 of 21 possible surrogates' owners have to try again."""
    monkeypatch.setattr(pii_surrogates, "BROADCAST_ENTITIES", few)
    texts = [f"write to {c}@x.example.com now" for c in "bcdfghjklmn"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r["text"] for r in replace_personal_data(frame).collect()}
    new = [re.search(r"\S+@\S+", rows[i])[0] for i in range(len(texts))]
    assert len(set(new)) == len(texts) and not set(new) & {t.split()[2] for t in texts}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "nothing here"), (4, "a@b.co"), (4, "a@b.co"), (None, "a@b.co"), (5, "x " * 100_000 + "575569573")]
    frame = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, replaced int")
    got = replace_personal_data(frame)
    assert got.columns == ["doc_id", "text", "replaced"]
    by_id = {r["doc_id"]: r["text"] for r in got.collect()}
    assert got.count() == len(rows)
    assert by_id[1] is None and by_id[2] == "" and by_id[3] == "nothing here"
    assert by_id[4] == by_id[None] != "a@b.co" and by_id[5].startswith("x x ") and not by_id[5].endswith("575569573")
    assert replace_personal_data(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert Entity(0, 1, "ip", canonical("ip", "010.1.1.1")).canonical == "10.1.1.1"


def test_formats_that_originals_fill(spark):
    """All names of a group, all one-letter names, letters outside the classes, short phone numbers."""
    names = [n for group in GIVEN.values() for n in group]
    texts = [f"{n} Stone" for n in names] + [f"Mr. {c} left" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    texts += ["Mr 李明 left", "Herr Ö left", "Herr Σ left", "Herr Ъ left", "Mr 김 left"]
    texts += [f"_@{c}.com" for c in "0123456789"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    new = {}
    for r in replace_personal_data(frame).collect():
        for e, f in zip(find_entities(texts[r["doc_id"]]), r["replaced"], strict=True):
            new.setdefault((e.kind, e.canonical), set()).add(canonical(e.kind, f["surrogate"]))
    assert {n.lower() for n in names} <= {text for _, text in new} and all(len(own) == 1 for own in new.values())
    made = {(kind, *own) for (kind, _), own in new.items()}
    assert len(made) == len(new) and not made & set(new)
    assert not any(set(text) & set(*own) for (_, text), own in new.items() if text in ("李明", "ö", "ъ", "김"))


def test_later_attempts_have_room():
    for attempt in range(2, 6):
        for names in GIVEN.values():
            own = [S.of("name", n.lower(), attempt=attempt) for n in names]
            assert len(set(own)) == len(names) and all(any(o.endswith(n.lower()) for n in names) for o in own)
    short = Entity(0, 8, "phone", "2345")
    own = S.written(short, "+1 23 45", attempt=6)
    assert re.fullmatch(r"\+1 \d\d \d{4}", own) and canonical("phone", own) == S.of("phone", "2345", attempt=6)


def test_many_names_are_found_in_one_pass():
    import time

    from stratiform.llm.pii_entities import find_entities

    def spelled(number):
        return "".join("abcdefghij"[int(d)] for d in str(number))

    names = [f"B{spelled(n)}" for n in range(20_000)]
    text = " ".join(f"Mr {name} came." for name in names) + " " + " ".join(names)
    began = time.perf_counter()
    found = find_entities(text)
    assert time.perf_counter() - began < 10
    assert len(found) == 40_000 and {text[e.start : e.end] for e in found} == set(names)


def test_a_name_is_no_part_of_a_longer_word():
    from stratiform.llm.pii_entities import find_entities

    text = "Mr Stone met Stones, Stone's dog and stone; Mrs Ann-Lee Day and Ann-Lees, Ann-Lee."
    assert [text[e.start : e.end] for e in find_entities(text)].count("Stone") == 2
