"""Repeated passages of words against brute force."""

import collections
import hashlib
import random
import re

import pytest

from quayside.llm import passages as ps, queries as llm

SCHEMA = "doc_id long, text string, row string, repeats int, who string, n long, places string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(texts, width=35):
    """(words, removed, kept words) of each text, every text a document of its own."""
    words = [words_of(t) for t in texts]
    seen = collections.Counter(tuple(w[s : s + width]) for w in words for s in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = set()
        for s in range(len(w) - width + 1):
            if seen[tuple(w[s : s + width])] > 1:
                gone |= set(range(s, s + width))
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def texts():
    r = random.Random(11)
    said = lambda n, k=400: " ".join(r.choice(["w", "Wé", "zu", "ß"]) + str(r.randrange(k)) for _ in range(n))
    passage, base, short = said(60), said(300), said(34)
    out = [said(r.randint(1, 200)) for _ in range(20)]
    out += [said(r.randint(0, 50)) + " " + passage + "\n" + said(r.randint(0, 50)) for _ in range(12)]  # other surroundings
    out += [base] * 4 + [base + " end", "start " + base, base.replace(" ", "  \t\n", 7)]
    out += [said(9) + " " + short + " " + said(9) for _ in range(3)]  # one word too few
    out += [said(20) + " " + short + " same " + said(20) for _ in range(3)]  # just enough
    out += [" ".join(["a"] * n) for n in (34, 35, 36, 200)]  # the window starts elsewhere in the same text
    out += [" ".join(["a", "b", "c"] * 30), " ".join(["a b"] * 40)]
    out += [base[: len(base) // 2].upper(), "A" + base[1:]]  # case counts
    out += ["", None, "   ", "\x0b\x0c", "one", said(20000, 40000) + " " + passage]
    # few words, so that short windows repeat by chance where long ones do not
    out += [" ".join(r.choice("ab") for _ in range(400)) for _ in range(6)]
    return out


@pytest.mark.parametrize("width", [1, 5, 12, 20, 35, 70])
def test_repeats_at_any_width(spark, width):
    rows = [(k, t, "r", 1, "w", None, "p") for k, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute([t for _, t, *_ in rows], width)
    got = {r["doc_id"]: r for r in ps.cut_repeats(docs, width=width).collect()}
    assert len(got) == len(rows)
    for k, t, *others in rows:
        assert got[k]["text"] == (want[k][2] if t is not None else None)
        assert [got[k][c] for c in ("row", "repeats", "who", "n", "places")] == others
    assert any(n for _, n, _ in want)


def test_query_against_brute_force(spark, tmp_path):
    rows = [(7 * k - 20, t) for k, t in enumerate(texts())]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in llm.QUERIES["op11_passages"](spark, str(tmp_path)).collect()}
    for (name, _), (n, removed, kept) in zip(rows, brute([t for _, t in rows])):
        assert tuple(got[name][c] for c in ("n_words", "n_removed", "kept_sha256")) == (
            n, removed, hashlib.sha256(kept.encode()).hexdigest())


def test_rows_without_an_id_and_copies_of_rows_are_documents(spark, tmp_path):
    r = random.Random(3)
    said = lambda n: " ".join(str(r.randrange(10**6)) for _ in range(n))
    copied, shared = said(40), said(50)
    rows = [(None, copied), (None, said(80)), (None, said(5) + " " + shared), (1, copied), (1, copied), (1, said(50)),
            (2, shared + " " + said(9)), (3, None), (None, None), (3, said(70))]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(
        (repr(g["doc_id"]), g["n_words"], g["n_removed"], g["kept_sha256"])
        for g in llm.QUERIES["op11_passages"](spark, str(tmp_path)).collect())
    assert got == sorted(
        (repr(name), n, removed, hashlib.sha256(kept.encode()).hexdigest())
        for (name, _), (n, removed, kept) in zip(rows, brute([t for _, t in rows])))


def test_a_passage_in_a_third_of_all_documents(spark):
    r = random.Random(4)
    said = lambda n: " ".join(str(r.randrange(10**5)) for _ in range(n))
    passage = said(45)
    rows = [(k, f"{said(30)} {passage} {said(30)}" if k % 3 == 0 else said(90)) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    removed = [n for _, n, _ in brute([t for _, t in rows])]
    for row in ps.with_repeats(docs).select("row.doc_id", "repeats").collect():
        covered = {p for s in row["repeats"] for p in range(s["first"], s["end"])}
        assert len(covered) == removed[row["doc_id"]] and (covered >= set(range(30, 75)) or row["doc_id"] % 3)


def test_lengths_double():
    assert ps.ladder(35) == [9, 18, 35] and ps.ladder(70) == [9, 18, 35, 70] and ps.ladder(5) == [5]
    for width in range(1, 141):
        steps = ps.ladder(width)
        assert steps[-1] == width and all(a < b <= 2 * a for a, b in zip(steps, steps[1:]))
