import re
import time


from hypothesis import given, settings
from hypothesis import strategies as st

from plateworks.llm import pii

KEY = b"test key"


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 400), st.integers(0, 10**6))
def test_rank_map_is_one_to_one_without_fixed_points(size, salt):
    made = [pii.next_in_rank(KEY, str(salt), x, size) for x in range(size)]
    assert sorted(made) == list(range(size)) and all(x != y for x, y in enumerate(made))


def test_formats_are_kept():
    card = "4539 1488 0343 6467"
    assert pii.luhn_digit("453914880343646") == 7
    text = f"Mail Ana.B+x@Mail7.example.com or ana.b+x@mail7.example.com, +1 (743) 555-3824, +1 743-555-3824, 227.5.221.1, {card}, 4041894974608795, 078-05-1120, GB82 WEST 1234 5698 7654 32, Frau Anna Müller, Mr. Smith, Mr Иванов. Version 2.0.1, 12345."
    new, counts, pairs = pii.replaced(KEY, text)
    assert counts == {"email": 2, "iban": 1, "card": 2, "ssn": 1, "ip": 1, "phone": 2, "name": 4}
    for _, entity, made in pairs:
        assert entity != made
    for old in ("Ana.B", "743", "227.5.221.1", "4539 1488", "4041894974608795", "078-05-1120", "WEST 1234", "Müller", "Anna", "Smith", "Иванов"):
        assert old not in new, old
    got = re.match(r"Mail (\S+) or (\S+), (\+1 \(\d{3}\) \d{3}-\d{4}), (\+1 \d{3}-\d{3}-\d{4}), (\d+\.\d+\.\d+\.\d+), (4\d{3} \d{4} \d{4} \d{4}), (4\d{15}), (\d{3}-\d\d-\d{4}), (GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d), Frau (\w+) (\w+), Mr\. (\w+), Mr (\w+)\. Version 2\.0\.1, 12345\.$", new)
    assert got and got[1].lower() == got[2] and re.sub(r"\D", "", got[3]) == re.sub(r"\D", "", got[4])
    digits = got[6].replace(" ", "")
    assert pii.luhn_digit(digits[:-1]) == int(digits[-1])
    assert pii._iban_rest(got[9].replace(" ", "")[4:] + got[9][:4]) == 1
    assert got[10] in pii.GIVEN["f", "latin"] and all("а" <= c.lower() <= "ё" for c in got[13])
    assert pii.replaced(b"other", text)[0] != new


def test_distinct_entities_stay_distinct():
    made = {pii.surrogate(KEY, "phone", f"+1 {n}") for n in range(2000000000, 2000002000)}
    assert len(made) == 2000 and all(re.fullmatch(r"\+1 [2-9]\d{9}", m) for m in made)
    assert len({pii.surrogate(KEY, "ip", f"10.0.{a}.{b}") for a in range(20) for b in range(100)}) == 2000
    assert len({pii.surrogate(KEY, "ip", f"{a}.0.0.0") for a in range(256)}) == 256


def test_documents(spark):
    rows = [(1, "a.b@x.org and c.d@x.org", 1), (2, "A.B@x.org", 2), (3, None, 3), (4, "", 4), (None, "x" * 100000 + " 10.1.2.3", 5), (1, "a.b@x.org and c.d@x.org", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _n_email int").selectExpr("*", "7 as kind")
    out = pii.replace(docs, KEY)
    got = out.collect()
    assert out.columns[:3] == ["doc_id", "text", "kind"] and len(got) == 6
    by = {r.doc_id: r for r in got}
    assert by[2].text.lower() == by[1].text.split()[0] and by[3].text is None and by[4].text == "" and by[None]["_n_ip"] == 1
    pairs = pii.surrogate_map(docs, KEY)
    assert pairs.count() == 3 and pii.collisions(pairs).isEmpty()
    assert not pii.collisions(pairs.selectExpr("kind", "entity", "'same' as surrogate", "n_mentions")).isEmpty()
    assert pii.replace(docs.limit(0), KEY).count() == 0


def test_later_mentions_of_a_name_take_its_surrogate():
    text = "Frau Anna Müller came. Later Müller said that Anna was here; Müller's dog, Annas Hund, Müllerstraße."
    new, counts, pairs = pii.replaced(pii.DEFAULT_KEY, text)
    made = {e: m for _, e, m in pairs}
    assert new == f"Frau {made['Anna']} {made['Müller']} came. Later {made['Müller']} said that {made['Anna']} was here; {made['Müller']}'s dog, {made['Anna']}s Hund, Müllerstraße."
    assert counts["name"] == 6 and set(made) == {"Anna", "Müller"}


def test_many_mentions_in_one_text():
    text = " ".join(f"user{k}@example{k}.org met Anna Schmidt{chr(97 + k % 26)} at 10.0.{k % 250}.{k // 250 % 250}" for k in range(30_000))
    began = time.perf_counter()
    assert len(pii.mentions(text)) == 4 * 30_000
    assert time.perf_counter() - began < 15


def test_values_of_the_result_name_one_entity(spark):
    """Every mention, by text and place, against a plain table of entities and surrogates."""
    names = ["Anna", "Barbara", "Peter", "Paul", "Maria"]
    rows = [(k, f"Mail p{k % 7}@a.org or P{k % 7}@A.org, call +49 30 123{k % 5}567, ask {names[k % 5]} Meier{chr(97 + k % 3)} on 10.1.2.{k % 9}.") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = {(r.kind, r.entity): r.surrogate for r in pii.surrogate_map(docs).collect()}
    assert len({(k, v) for (k, _), v in pairs.items()}) == len(pairs)
    assert {(r.kind, r.surrogate) for r in pii.reused(pii.surrogate_map(docs)).collect()} == {(k, v) for (k, _), v in pairs.items() if (k, v) in pairs}
    got = {r.doc_id: r for r in pii.replace(docs).collect()}
    for k, text in rows:
        want, at = [], 0
        for a, b, kind, found in pii.mentions(text):
            entity = found.lower() if kind == "email" else f"+49 {re.sub('[^0-9]', '', found)[2:]}" if kind == "phone" else found
            made = pairs[kind, entity]
            if kind == "phone":
                digits = iter(re.sub("[^0-9]", "", made))
                made = "".join(next(digits) if c.isdigit() else c for c in found)
            elif kind == "email":
                made = "".join(c.upper() if f.isupper() else c for c, f in zip(made, found))
            want += [text[at:a], made]
            at = b
        assert got[k].text == "".join([*want, text[at:]]) and got[k]._n_email == 2 and got[k]._n_phone == 1 and got[k]._n_name == 2 and got[k]._n_ip == 1


def test_names_in_other_case_and_genitive():
    text = "Frau Anna Müller rief an. ANNA MÜLLER! Das ist Müllers Haus, anna müller schrieb; eine anna allein, ein müller allein. Mr BROWN has a brown dog."
    new, counts, pairs = pii.replaced(KEY, text)
    made = {e: m for _, e, m in pairs}
    a, m, b = made["Anna"], made["Müller"], made["Brown"]
    assert new == f"Frau {a} {m} rief an. {a.upper()} {m.upper()}! Das ist {m}s Haus, {a.lower()} {m.lower()} schrieb; eine anna allein, ein müller allein. Mr {b.upper()} has a brown dog."
    assert counts["name"] == 8 and set(made) == {"Anna", "Müller", "Brown"}


def test_addresses_stay_in_their_kind():
    import ipaddress

    kinds = lambda x: [getattr(ipaddress.ip_address(x), k) for k in ("is_loopback", "is_link_local", "is_multicast")] + [ipaddress.ip_address(x) in ipaddress.ip_network(n) for n in ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "100.64.0.0/10", "0.0.0.0/8")]
    for block in ("10.0.0.1", "172.31.255.1", "192.168.1.7", "127.0.0.1", "169.254.3.4", "100.127.0.9", "8.8.8.8", "172.32.0.1", "11.0.0.0", "223.255.255.255", "224.0.0.1", "255.255.255.255", "0.0.0.0"):
        made = pii.surrogate(KEY, "ip", block)
        assert made != block and kinds(made)[0] == kinds(block)[0] and kinds(made)[1] == kinds(block)[1] and kinds(made)[3:] == kinds(block)[3:], (block, made)
    public = [f"{a}.{b}.0.{a}" for a in range(1, 224) for b in (0, 15, 16, 31, 32, 63, 64, 127, 128, 168, 254)]
    public = [x for x in public if not any(kinds(x)[k] for k in (0, 1, 3, 4, 5, 6, 7))]
    made = {pii.surrogate(KEY, "ip", x) for x in public}
    assert len(made) == len(public) and not any(kinds(x)[k] for x in made for k in range(8))


def test_parts_of_mail_addresses_keep_their_identity():
    made = [pii.surrogate(KEY, "email", x) for x in ("ann@acme.com", "bob@acme.com", "ann@other.org", "ann@acme.org")]
    users, domains = zip(*(x.split("@") for x in made))
    assert users[0] == users[2] == users[3] != users[1] and domains[0] == domains[1] and domains[0].split(".")[0] == domains[3].split(".")[0] != domains[2].split(".")[0]
    assert "acme" not in "".join(made) and not set(users) & {"ann", "bob"} and [d.split(".")[-1] for d in domains] == ["com", "com", "org", "org"]


def test_mentions_by_an_independent_finder(spark):
    """Surrogates in the result, told from texts made of known entities, without the library's own finder."""
    import ipaddress

    people = [("Frau", "Anna", "Müller"), ("Herr", "Karl", "Weiß"), ("Mr", "Paul", "Smith"), ("Ms", "Emma", "Jones")]
    hosts = ["10.2.3.4", "192.168.0.9", "8.8.4.4", "127.0.0.1"]
    parts = lambda k: (people[k % 4], f"u{k % 5}x@firm{k % 3}.org", hosts[k % 4], f"+49 30 {1000000 + k % 6}")
    rows = [(k, "{0[0]} {0[1]} {0[2]} <{1}> [{2}] ({3}) {0[2]} {4} {0[1]}s".format(*parts(k), parts(k)[0][2].upper())) for k in range(120)]
    seen = {}
    for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect():
        got = re.fullmatch(r"(\w+) (\w+) (\w+) <(.+)@(.+)> \[(.+)\] \((.+)\) (\w+) (\w+) (\w+)s", r.text)
        person, mail, host, phone = parts(r.doc_id)
        user, domain = mail.split("@")
        assert got[1] == person[0] and got[3] == got[8] and got[9] == got[3].upper() and got[10] == got[2]
        for kind, real, made in (("given", person[1], got[2]), ("name", person[2], got[3]), ("user", user, got[4]), ("domain", domain, got[5]), ("ip", host, got[6]), ("phone", phone, got[7])):
            assert real != made and seen.setdefault((kind, real), made) == made
        assert ipaddress.ip_address(host).is_private == ipaddress.ip_address(got[6]).is_private
    for kind in ("given", "name", "user", "domain", "ip", "phone"):
        made = [v for (k, _), v in seen.items() if k == kind]
        assert len(made) == len(set(made))
