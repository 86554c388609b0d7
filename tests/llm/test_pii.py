import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from siltgauge.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def brute(text):
    keep = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda m: 12 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d),
        "phone": lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15,
    }
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if keep[kind](m[0])]
    return sorted(found)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a@.1+- ()4é%", max_size=40))
def test_base_patterns(text):
    assert pii.identifiers(text) == brute(text)


def test_base_patterns_on_made_up_texts():
    draw = random.Random(7)
    parts = ["bob@x.org", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "+1 (743) 555-3824", "@", ".", "-", " ", "9", "a", "+4"]
    for _ in range(2000):
        text = "".join(draw.choice(parts) for _ in range(8))
        assert pii.identifiers(text) == brute(text)


def found(text):
    base = pii.identifiers(text)
    return [(pii.KINDS[k], text[a:b]) for a, k, b in pii.disguised(text, base)]


def test_disguises_map_back_to_the_source():
    assert found("write to jane.doe [at] mail (dot) example [dot] org now") == [("email", "jane.doe [at] mail (dot) example [dot] org")]
    assert found("write jane at example dot com, please") == [("email", "jane at example dot com")]
    assert found("or jane.doe at example.com today") == [("email", "jane.doe at example.com")]
    assert found("or jane@example dot com") == [("email", "jane@example dot com")]
    assert found("look at example.com or at home.de") == []
    assert found("mail bоb＠exаmple。org!".replace("。", "．")) == [("email", "bоb＠exаmple．org")]
    assert found("é call plus four nine one seven zero five five five one two three now") == [
        ("phone", "plus four nine one seven zero five five five one two three")
    ]
    assert found("ip one nine two dot one six eight dot one dot two, ok") == [("ip", "one nine two dot one six eight dot one dot two")]
    assert found("４１１１ １１１１ １１１１ １１１１") == [("card", "４１１１ １１１１ １１１１ １１１１")]
    assert found("a​b@exam​ple.org")[:1] in ([], [("email", "a​b@exam​ple.org")])


def test_plain_prose_has_no_disguised_spans():
    for text in ["meet me at the dot of noon", "one two three", "un deux trois", "at noon (at last) we [dot] the i", "der an dem Punkt"]:
        assert found(text) == []


def test_rows(spark):
    rows = [(1, "x a@b.co 1.2.3.4", "k"), (2, None, "k"), (3, "", None), (None, "+1 743 555 3824", "k"), (1, "x a@b.co 1.2.3.4", "k"), (4, "5" * 100_000 + "@" * 1000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = sorted(pii.find_personal_data(docs).collect(), key=str)
    assert len(out) == len(rows)
    for r in out:
        text = next(t for i, t, _ in rows if i == r.doc_id) or ""
        spans = brute(text) if len(text) < 1000 else []
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert (r.spans, r.base_sha256) == (listed, hashlib.sha256(listed.encode()).hexdigest())
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in spans) for n in range(4)]
    assert pii.find_personal_data(docs.limit(0)).collect() == []


def test_fragments_do_not_hide_the_whole():
    for text, whole in [
        ("to jоhn.doe@example.com now", ("email", "jоhn.doe@example.com")),
        ("to john.doe@mail.example[dot]com now", ("email", "john.doe@mail.example[dot]com")),
        ("to john.doe@example.cоm now", ("email", "john.doe@example.cоm")),
        ("call +44 20 7946 01 two three four", ("phone", "+44 20 7946 01 two three four")),
    ]:
        assert pii.identifiers(text), text
        assert found(text) == [whole]
        assert pii.examine(text)[-1] == 1 and sum(pii.examine(text)[:4]) == 1


def test_base_spans_are_not_repeated():
    assert found("é a@b.co, +1 743 555 3824 and c [at] d.org, 1.2.3.4") == [("email", "c [at] d.org")]


def test_any_ending_after_a_spelled_dot():
    for ending in ("ch", "it", "nl", "ca", "at", "museum"):
        assert found(f"or jane.doe at firma dot {ending} today") == [("email", f"jane.doe at firma dot {ending}")]
    assert found("or jane at mail dot firma dot nl, yes") == [("email", "jane at mail dot firma dot nl")]
    assert found("write jane at example dot com dot yes") == [("email", "jane at example dot com")]
