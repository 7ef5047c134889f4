"""Pseudonyms and quotation links on small tables: what has to hold of the results, and cases worked out by hand."""

import datetime
import random
import re

import pytest
import texts

from tallycube.llm import pii, quotes

KEY = "test key"
VALUES = [
    "4539578763621486",
    "4539 5787 6362 1486",
    "+1 (988) 555-2485",
    "(212) 555-0187",
    "ann.smith42@mail8.example.com",
    "70.123.182.155",
    "1985-02-28",
    "2000-02-29",
    "28.02.1985",
    "12/31/1999",
    "31/12/1999",
    "123-45-6789",
    "DE89370400440532013000",
]
INVALID = ["4539578763621487", "1985-02-30", "2001-02-29", "1850-01-01", "666-45-6789", "000-12-3456", "DE88370400440532013000", "256.1.1.1", "1.2.3.4.5", "12345", "v1.2.3", "hex 0641917ea4e9feb9"]


def luhn(s):
    digits = [int(c) for c in reversed(s) if c.isdigit()]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def replaced(table, values):
    out = pii.pseudonymise(table([(k, f"x {v} y") for k, v in enumerate(values)]), KEY).orderBy("doc_id").collect()
    return [r.text[2:-2] for r in out], [list(r.pii_kinds) for r in out]


def test_formats_and_validity_stay(table):
    new, kinds = replaced(table, VALUES)
    assert [k[0] for k in kinds] == ["card", "card", "phone", "phone", "email", "ipv4", "date", "date", "date", "date", "date", "ssn", "iban"]
    for old, now in zip(VALUES, new, strict=True):
        assert now != old and len(now) == len(old)
        if "@" not in old:
            assert re.sub(r"\d", "9", now) == re.sub(r"\d", "9", old) or old.startswith("DE")
    assert luhn(new[0]) and luhn(new[1])
    assert new[2].startswith("+1 (") and new[4].endswith("@mail8.example.com")
    assert all(0 <= int(o) <= 255 for o in new[5].split("."))
    for k, form in ((6, "%Y-%m-%d"), (7, "%Y-%m-%d"), (8, "%d.%m.%Y"), (9, "%m/%d/%Y"), (10, "%d/%m/%Y")):
        assert 1900 <= datetime.datetime.strptime(new[k], form).year < 2100
    moved = new[12][4:] + new[12][:4]
    assert int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def test_invalid_values_stay(table):
    assert replaced(table, INVALID) == (INVALID, [[] for _ in INVALID])


def test_cards_and_ibans_beside_other_numbers(table):
    card, iban = "4111 1111 1111 1111", "DE89 3704 0044 0532 0130 00"
    values = [card, f"{card} 123", f"{card} 12/26", f"no 12 {card}", "no 12 4111111111111111", f"{card} 5500 0000 0000 0004"]
    values += [f"{card} 2024-01-01", f"{card} 123-45-6789", f"{card} 212-555-0187", f"212-555-0187 {card}", f"AB12 {card}", f"{card} 7 apples", f"{card} 12ab"]
    values += [iban, f"{iban} {card}", f"BE68 5390 0754 7034 {card}", f"BE68 5390 0754 7034 USD", f"{iban} 123-45-6789", "NO93 8601 1117 947", "DE88 3704 0044 0532 0130 00"]
    new, kinds = replaced(table, values)
    assert kinds[:6] == [["card"]] * 5 + [["card", "card"]]
    assert kinds[6:13] == [["card", "date"], ["card", "ssn"], ["card", "phone"], ["phone", "card"], ["card"], ["card"], ["card"]]
    assert kinds[13:] == [["iban"], ["iban", "card"], ["iban", "card"], ["iban"], ["iban", "ssn"], ["iban"], []]
    moved = new[0]
    assert luhn(moved) and new[1] == f"{moved} 123" and new[2] == f"{moved} 12/26" and new[3] == f"no 12 {moved}" and new[-1] == values[-1]
    assert new[10] == f"AB12 {moved}" and new[11] == f"{moved} 7 apples" and new[14] == f"{new[13]} {moved}" and new[17].startswith(f"{new[13]} ")
    plain = new[13].replace(" ", "")
    assert new[13] != iban and re.sub(r"\d", "9", new[13]) == re.sub(r"\d", "9", iban)
    assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def test_equal_values_stay_linked_and_different_ones_apart(table):
    days = [(datetime.date(1900, 1, 1) + datetime.timedelta(n)).isoformat() for n in range(0, 73049, 61)]
    octets = [f"10.0.{n // 256}.{n % 256}" for n in range(600)]
    new, _ = replaced(table, days + octets)
    assert len(set(new)) == len(days) + len(octets)
    again, _ = replaced(table, days[:50])
    assert again == new[:50]


def test_rows_of_numbers_are_no_cards(table):
    rng = random.Random(5)
    values = [
        " ".join(map(str, range(1, 31))),
        "prices 1200 3400 5600 7800 9100 1130 2250",
        "9807915762804490",  # passes the check, but nobody issues it
        " ".join(str(rng.randrange(10, 1000)) for _ in range(300)),
        " ".join(f"{rng.randrange(10**5)}-{rng.randrange(10**4)}" for _ in range(200)),
    ]
    assert replaced(table, values) == (values, [[] for _ in values])


def test_one_value_has_one_pseudonym_in_all_layouts(table):
    cards = ["4539578763621486", "4539 5787 6362 1486", "4539-5787-6362-1486"]
    ibans = ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00"]
    days = ["1985-02-28", "28.02.1985", "02/28/1985", "2/28/1985"]
    new, kinds = replaced(table, cards + ibans + days)
    assert {k[0] for k in kinds[:3]} == {"card"} and len({re.sub("[ -]", "", x) for x in new[:3]}) == 1
    assert len({x.replace(" ", "") for x in new[3:5]}) == 1
    y, m, d = map(int, new[5].split("-"))
    assert [list(map(int, re.findall(r"\d+", x))) for x in new[6:]] == [[d, m, y], [m, d, y], [m, d, y]]
    for layout, shown in zip([*cards, *ibans], new[:5], strict=True):
        assert re.sub(r"\d", "9", layout) == re.sub(r"\d", "9", shown)


def test_the_key_stands_in_no_plan(table):
    df = pii.pseudonymise(table([(1, "4539578763621486")]), "very secret key")
    execution = df._jdf.queryExecution()
    assert "very secret" not in execution.toString() and df.collect()[0].pii_kinds == ["card"]
    assert "very secret" not in execution.toString()


def test_long_lines_of_numbers_take_linear_time(table):
    import time

    line = " ".join(str(k % 10_000) for k in range(16_000))
    start = time.time()
    assert pii.pseudonymise(table([(1, line)]), KEY).collect()[0].text == line
    assert time.time() - start < 30


def test_small_domains_are_permuted(table):
    # All dates of one format whose day is 31: each comes out once.
    days = [datetime.date(y, m, 31).isoformat() for y in range(1900, 2100) for m in (1, 3, 5, 7, 8, 10, 12)]
    new, _ = replaced(table, days)
    assert sorted(new) == sorted(days)


def test_pseudonyms_odd_rows(table):
    long = texts.prose(1, 20_000) + " 70.123.182.155 " + texts.prose(2, 10)
    rows = [(1, None, "a"), (2, "", "b"), (2, "", "b"), (3, long, "c"), (None, "1985-02-28 and 1985-02-28, 1985-02-28", "d")]
    out = pii.pseudonymise(table(rows, "doc_id long, text string, PII_kinds string"), KEY)
    assert out.columns == ["doc_id", "text", "pii_kinds"]
    got = sorted(out.collect(), key=str)
    assert [(r.doc_id, r.text) for r in got if r.doc_id in (1, 2)] == [(1, None), (2, ""), (2, "")]
    same = next(r for r in got if r.doc_id is None)
    assert len(set(re.findall(r"\d{4}-\d\d-\d\d", same.text))) == 1 and len(same.pii_kinds) == 3
    third = next(r for r in got if r.doc_id == 3)
    assert len(third.text) == len(long) and third.text.split(" ")[:20_000] == long.split(" ")[:20_000]
    assert pii.pseudonymise(table([]), KEY).count() == 0


# quotation links

MESSAGES = [
    (1, 0, "u", "Hello there friend.\nHow does packing work?"),
    (1, 1, "a", "> How does packing work?\nIt fills windows.\n\nBest fit is used."),
    (1, 2, "u", "On Monday X wrote:\n> > How does packing work?\n> It fills windows.\nWhy best fit?"),
    (1, 3, "u", "no quote"),
    (2, 0, "u", "> Hello there friend.\nciting other"),
    (2, 1, "a", "> it FILLS, windows\nok"),
    (3, 0, "u", None),
    (None, 1, "u", "> Hello there friend."),
    (4, 0, "u", ""),
    (4, 1, "u", "> no quote found of this\n"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def test_quotes_link_and_order(table):
    out = {(r.conv_id, r.turn): r for r in quotes.link(table(MESSAGES, SCHEMA)).collect()}
    parent = {k: (r.parent_conv, r.parent_turn) for k, r in out.items()}
    assert parent[(1, 1)] == (1, 0) and parent[(1, 2)] == (1, 1) and parent[(1, 3)] == (None, None)
    assert parent[(2, 0)] == (1, 0) and parent[(2, 1)] == (1, 1)
    assert [out[k].depth for k in ((1, 0), (1, 1), (1, 2), (2, 0), (2, 1))] == [0, 1, 2, 1, 2]
    assert all((r.root_conv, r.root_turn) == (1, 0) for k, r in out.items() if k in ((1, 1), (1, 2), (2, 0), (2, 1)))
    assert out[(1, 2)].text == "Why best fit?" and out[(1, 2)].max_level == 2 and out[(1, 2)].n_quotes == 2
    assert out[(3, 0)].text == "" and out[(4, 1)].n_linked == 0 and out[(None, 1)].parent_conv is None
    assert len(out) == len(MESSAGES)


def test_long_chains_of_replies(table):
    rows = [(1, 0, "u", "message number zero")] + [(1, k, "u", f"> message number {'zero' if k == 1 else f'n{k - 1}'}\nmessage number n{k}") for k in range(1, 70)]
    out = {r.turn: r for r in quotes.link(table(rows, SCHEMA)).collect()}
    assert [out[k].depth for k in range(70)] == list(range(70)) and {r.root_turn for r in out.values()} == {0}


def test_frequent_lines_do_not_multiply(table):
    rows = [(c, 0, "u", "the very common line") for c in range(300)] + [(c, 1, "u", "> the very common line\nyes") for c in range(300)]
    out = quotes.link(table(rows + rows[:5], SCHEMA)).collect()
    assert len(out) == 605 and all(r.parent_conv == r.conv_id for r in out if r.turn == 1)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)]])
def test_quotes_of_nothing(table, rows):
    assert quotes.link(table(rows, SCHEMA)).count() == len(rows)
