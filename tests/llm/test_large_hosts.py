from __future__ import annotations

from collections import Counter

import pytest

from orderlens.llm import pages

SCHEMA = "page_id long, url string, html string"
URL = "https://big.example.org/{}"


def unmarked_pages():
    """A host of many arrays: texts of their own, menus on 2, 3 and 40 pages, copies, odd pages."""
    rows = []
    for i in range(700):
        own = " ".join(f"w{i}x{j}" for j in range(12))
        menu = ""
        if i in (3, 350):
            menu = " ".join(f"two{j}" for j in range(9))
        elif i in (11, 333, 680):
            menu = " ".join(f"three{j}" for j in range(9))
        elif i % 17 == 0:
            menu = " ".join(f"many{j}" for j in range(11))
        body = f"<div>{menu} end</div><p>{own}</p>"
        if i % 100 == 99:  # a marked page holds a menu too, and keeps it
            body = f"<article><p>{' '.join(f'three{j}' for j in range(9))}</p></article>"
        rows.append((i, URL.format(i), body))
    # copies of one page, with other markup, count once
    rows += [(1000 + i, URL.format("c"), f"<p>{'copy ' * 3}a b c d e f g h</p>{'<hr>' * i}") for i in range(300)]
    rows += [(None, URL.format("n"), None), (None, URL.format("n"), "")]
    rows += [(2000 + i, f"https://s{i % 3}.example.org/", f"<p>{'same words on all of the pages here'} t{i}</p>") for i in range(9)]
    return rows


@pytest.mark.parametrize("partitions", [1, 8, 64])
def test_large_hosts_are_counted_over_all_their_arrays(spark, partitions):
    rows = unmarked_pages()
    hosts: dict[str, list] = {}
    for row in rows:
        hosts.setdefault(row[1].split("/")[2], []).append(row)
    want = Counter()
    for of_host in hosts.values():  # one array for each host, whatever its size
        found = pages.main_texts([html or "" for _, _, html in of_host])
        want.update((r[0], text, n) for r, (text, n) in zip(of_host, found, strict=True))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(4)
        got = Counter((r["page_id"], r["text"], r["n_repeated"]) for r in pages.extract(df).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == want
    texts = {k[0]: k[1] for k in got if k[0] is not None}
    assert "three" not in texts[333] and "many" not in texts[17] and "two0" in texts[350]
    assert "three0" in texts[99] and texts[1000].startswith("copy")


def test_substrings_are_those_of_the_pages():
    texts = [["a", "b", "a", "b", "a"], ["b", "a", "b"], ["b"], []]
    found = {}
    for digest, on in pages.substrings(texts, long=2):
        for page, places in on:
            for at in places:
                found[page, at] = digest
    assert set(found) == {(0, 0), (0, 1), (0, 2), (0, 3), (1, 0), (1, 1)}
    assert found[0, 0] == found[0, 2] == found[1, 1] != found[0, 1] == found[1, 0]


def marked_pages():
    """A large host whose pages all mark their text; one notice is on three pages far apart."""
    rows = []
    for i in range(900):
        own = " ".join(f"w{i}x{j}" for j in range(20))
        notice = " ".join(f"three{j}" for j in range(9)) if i in (5, 450, 870) else ""
        rows.append((i, URL.format(i), f"<div>{notice}</div><article><p>{own}</p></article>"))
    return rows


@pytest.mark.parametrize("broadcast", [64 << 20, 0])
def test_marked_hosts_are_counted_over_all_their_arrays(spark, monkeypatch, broadcast):
    """Where markup decides, repetition is still counted on all pages of the host."""
    monkeypatch.setattr(pages, "BROADCAST_BYTES", broadcast, raising=False)
    df = spark.createDataFrame(marked_pages(), SCHEMA).repartition(4)
    found = {r["page_id"]: r for r in pages.extract(df).collect()}
    assert len(found) == 900
    assert {i: r["n_repeated"] for i, r in found.items() if r["n_repeated"]} == {5: 9, 450: 9, 870: 9}
    assert all(r["text"].startswith(f"w{i}x0 ") for i, r in found.items())


def test_equal_substrings_have_equal_keys():
    same = " ".join(f"s{j}" for j in range(10))

    def keys(*of):
        return pages._Array([h for h, _ in of], [pages.read_blocks(f"<p>{t}</p>") for _, t in of]).keys()

    at, key = keys(("h", f"a a a {same} b"), ("h", "few words"), ("h", ""), ("h", f"c {same}"), ("o", same))
    by_place = dict(zip(at.tolist(), key.tolist(), strict=True))
    # 14 tokens, two, none, 11 and 10
    assert [by_place[i] for i in (3, 4, 5)] == [by_place[i] for i in (17, 18, 19)]
    assert by_place[3] != by_place[27] and max(by_place) == 29 and len(by_place) == 7 + 4 + 3
