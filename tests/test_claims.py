"""The claim language."""

import random
import re
from datetime import date

import pytest

from catenary.functions.claims import ClaimError, decisions_document, parse, parse_record, parse_statement, scalar
from catenary.functions.content import canonical_json, normalized
from catenary.sources import plans
from catenary.sources.http import Client, retry_after

#: Statements that stand, one for each form of the grammar, and what each mutation makes of a statement that cannot stand.
STANDING = ('film://9 :: cut="a b",disc={2,3} @6 <~> [tape://7 @4,tape://8 @2]', "film://9 :: disc=4.. => tape://7", "film://9 :: ** <=> [tape://7,[tape://8]]")
MUTATIONS = {
    "no space before the operator": lambda t: re.sub(r" (?=<=>|<~>|=>)", "", t, count=1),
    "a tab for a space": lambda t: t.replace(" ", "\t", 1),
    "a space at the end": lambda t: t + " ",
    "half of it": lambda t: re.split("(?<=>) ", t)[0],
    "one side more": lambda t: t + " => x://1",
    "nothing after the scheme": lambda t: t.replace("tape://7", "tape://", 1),
    "no scheme": lambda t: t.replace("film://", "film", 1),
    "a dimension twice": lambda t: t.replace("disc=", "disc=1,disc=", 1),
    "no members in a set": lambda t: t.replace("{2,3}", "{}"),
    "no bounds": lambda t: t.replace("4..", "..", 1),
    "no extent": lambda t: t.replace("@6", "@0"),
    "an extent with a sign": lambda t: t.replace("@6", "@-6"),
    "an extent beyond 64 bits": lambda t: t.replace("@6", "@18446744073709551616"),
    "an empty composite": lambda t: re.sub(r"\[.*\]", "[]", t),
    "a space in a composite": lambda t: t.replace(",tape", ", tape").replace(",[", ", ["),
    "an open composite": lambda t: t[:-1] if t.endswith("]") else t,
    "an unknown escape": lambda t: t.replace('"a b"', '"a\\qb"'),
    "an extent for a value": lambda t: t.replace('"a b"', "@6"),
    "a comment after all": lambda t: t + "\n# end",
    "an annotation without content": lambda t: "#@note\n" + t,
    "a blank line between": lambda t: t + "\n\n" + t,
}
REFUSED = sorted({made for change in MUTATIONS.values() for t in STANDING if (made := change(t)) != t})


def test_standing_and_every_mutation_bites():
    assert all(parse_record(t).statement for t in STANDING)
    assert all(any(change(t) != t for t in STANDING) for change in MUTATIONS.values())


def test_composites_of_selectors():
    text = "[a://1 :: x=1,y=2..3,a://2 :: x=1,b://3] => c://1"
    assert parse_statement(text).canonical() == text and [s.reference for s in parse_statement(text).left.parts] == ["a://1", "a://2", "b://3"]


@pytest.mark.parametrize("text", REFUSED)
def test_refused(text):
    with pytest.raises(ClaimError):
        parse(text)


@pytest.mark.parametrize(
    ("text", "canonical"),
    [
        ("b://2  <=>  a://1", "a://1 <=> b://2"),
        ("b://2 => a://1", "b://2 => a://1"),
        ("a://1 :: z={9,10,9},b=* @4 <~> b://1 @6", "a://1 :: b=*,z={10,9} @2 <~> b://1 @3"),
        ("[q://8 @15,p://5 @10] <~> r://1 @25", "[q://8 @3,p://5 @2] <~> r://1 @5"),
        ('a://x::y :: q="a b\\n",r=.."@5" => b://1', 'a://x::y :: q="a b\\n",r=.."@5" => b://1'),
        ("a://1 :: ** <~> b://1 :: x=2.. @18446744073709551615", "a://1 :: ** <~> b://1 :: x=2.. @18446744073709551615"),
    ],
)
def test_canonical(text, canonical):
    assert parse_record(text).statement.canonical() == canonical
    assert parse_record(canonical + "\n").statement.canonical() == canonical


def test_identity_ignores_metadata_order_and_scale():
    a = parse_record("# why\n#@by me\nb://2 @6 <~> a://1 @4\r\n").statement
    assert a.claim_id() == parse_statement("a://1 @2 <~> b://2 @3").claim_id() != parse_statement("a://1 @2 => b://2 @3").claim_id()
    assert a.claim_id(b"x\0") != a.claim_id()


def test_scalars_round_trip():
    r = random.Random(1)
    for _ in range(300):
        text = "".join(r.choice('ab1@:.+-_%" \\\n\té日') for _ in range(r.randint(0, 6)))
        if any(ord(c) < 32 and c not in "\n\t" for c in text):
            continue
        assert parse_record(f"a://1 :: x={scalar(text)} => b://1").statement.left.predicates[0][1].items == (text,)


def test_depth_is_limited():
    parse_statement("[" * 126 + "a://1" + "]" * 126 + " => b://1")
    with pytest.raises(ClaimError):
        parse_statement("[" * 200 + "a://1" + "]" * 200 + " => b://1")


def test_documents_of_decisions():
    a, b = parse_record("a://1 <=> b://1"), parse_record("a://2 <=> b://2")
    yes, no = decisions_document([(b, True), (a, False)])
    assert (yes, no) == (b.canonical(), a.canonical())
    with pytest.raises(ClaimError):
        decisions_document([(a, True), (a, False)])


def test_content():
    assert canonical_json({"b": [1e-8, 1.0, None], "a": "é"}) == '{"a":"é","b":[1e-8,1.0,null]}'
    assert normalized("ΟΔΟΣ  ①—Ｆoo!") == "οδοσ 1 foo"
    assert normalized(None) == ""


def test_plans():
    assert [x for r in plans.id_ranges(3, 160, 50, 2) for x in r] == [(4, 53), (54, 103), (104, 153), (154, 160)]
    assert list(plans.airing_windows(0, 10, lambda a, b: (b - a) * 30)) == [(0, 2), (2, 5), (5, 7), (7, 10)]
    with pytest.raises(ValueError):
        list(plans.airing_windows(0, 4, lambda a, b: 1000))
    windows = plans.change_windows(86400 * 100, 86400 * 130)
    assert windows[0][0] == date(1970, 4, 10) and all((b - a).days < 12 for a, b in windows) and windows[-1][1] == date(1970, 5, 11)
    assert plans.export_names(date(2024, 3, 1))[0] == "movie_ids_02_29_2024.json.gz"
    assert plans.next_page("https://x/y?page=3&a=1", 2) == 3 and plans.next_page(None, 2) is None
    with pytest.raises(ValueError):
        plans.next_page("https://x/y?page=2", 2)
    assert plans.checked_domains(("tv", "movie"), ("movie", "tv")) == ("movie", "tv")
    with pytest.raises(ValueError):
        plans.checked_domains(("tv", "x"), ("movie", "tv"))


def test_client_waits_and_retries():
    import io
    import urllib.error

    now, slept, answers = [0.0], [], [429, 500, b"ok", 404]

    def opener(url):
        answer = answers.pop(0)
        if isinstance(answer, int):
            raise urllib.error.HTTPError(url, answer, "", {"Retry-After": "7"} if answer == 429 else {}, io.BytesIO())
        return io.BytesIO(answer)

    client = Client(0.5, opener, lambda: now[0], lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    assert client.get("u") == b"ok" and max(slept) == 7.0 and client.get("u") is None
    assert retry_after("3", 0) == 3.0 and retry_after("Thu, 01 Jan 1970 00:01:00 GMT", 10) == 50.0
