import random
import re

from pyspark.sql import functions as F

from lotwise.llm import queries, secret_scan

HEX = "0123456789abcdef" * 2
KEY = "AKIA" + "ABCDEFGH12345678"


def test_base_spans_are_the_plain_matches():
    texts = [
        'password = "hunter22x"', "PASSWORD:abc", "passwd:=x", f"é {HEX} {KEY}Z", "apikey='abcdef' api_key: a.b/c+d=e",
        f"token={HEX}", "AKIA123 AKIAAKIA" + "Q" * 20, "secret: ſecret: tokens=abcdefg", "", "a" * 23, "ab" * 12 + "g" + "a" * 24,
        'x token": "abc-def_1" y', "password password = longenough",
    ]
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for text in texts:
        want = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 6]
        want += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        got = [s[:3] for s in secret_scan.scan(text) if s[0] != "guess"]
        assert sorted(got) == sorted(want), text
        assert got == sorted(got, key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))


def _cheapest(value):
    """The minimum over all segmentations, by recursion instead of a table."""
    spans = [*secret_scan._words(value), *secret_scan._dates(value), *secret_scan._repeats(value), *secret_scan._walks(value)]

    def best(at, open_brute):
        if at == len(value):
            return 0.0
        cut = 0 if open_brute else secret_scan._CUT_LOG10
        costs = [cut + 1.0 + best(at + 1, True)]
        costs += [secret_scan._CUT_LOG10 + c + best(e, False) for b, e, c in spans if b == at]
        return min(costs)

    return max(0.0, best(0, False) - secret_scan._CUT_LOG10) if value else 0.0


def test_guess_cost_is_the_cheapest_segmentation():
    for value in ("", "a", "password", "P@ssw0rd1", "qwerty2024", "aaaaaaab", "x9$kQ!z", "abcabcabc", "19991231love", "zxcvfr", "dragonmonkey"):
        assert abs(secret_scan.guess_log10(value) - _cheapest(value)) < 1e-9, value


def test_guess_cost_orders_weak_before_strong():
    weak = ["password", "Password1", "qwertyuiop", "aaaaaaaaaaaa", "12/31/1999", "abcabcabcabc", "monkeydragon", "123456789"]
    strong = ["x7Gq!29z#Lp0", "gT5-vbnQ2.rw8u", "Tr0ub4dor&3zQpX"]
    assert max(map(secret_scan.guess_log10, weak)) < secret_scan.MIN_GUESS_LOG10 <= min(map(secret_scan.guess_log10, strong))


def test_the_method_adds_values_the_patterns_miss():
    kinds = lambda text: [s[0] for s in secret_scan.scan(text)]
    assert kinds("pwd: x7Gq!29z#Lp0") == ["guess"]
    assert kinds("passphrase = 'zK9 q!x7 Gq29z#'") == ["guess"]
    assert kinds("pwd: password1") == []
    assert kinds("password: x7Gq29zLp0Qr") == ["assign"]
    assert kinds("The token was passed on: nobody knows.") == []


def test_rows_of_every_kind(spark, documents):
    long = "word " * 40_000 + f"token={HEX}"
    docs = documents((1, None), (1, None), (2, ""), (3, f"é token={HEX}"), (None, KEY), (5, long))
    got = secret_scan.with_secrets(docs, keep=["doc_id"]).collect()
    assert sorted((r.doc_id or 0, len(r.secrets)) for r in got) == [(0, 1), (1, 0), (1, 0), (2, 0), (3, 2), (5, 2)]
    assert secret_scan.with_secrets(documents()).count() == 0
    clash = docs.withColumn("secrets", F.lit(1))
    assert secret_scan.with_secrets(clash).columns[-1] == "secrets_"
    hidden = {r.doc_id: r.text for r in secret_scan.redact(docs).collect()}
    assert hidden[3] == "é [secret]" and hidden[1] is None and hidden[2] == "" and hidden[None] == "[secret]"
    assert secret_scan.redact(docs).columns == docs.columns


def test_query_lists_what_the_scan_finds(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in queries.op4_secret_scan(spark, small).collect():
        found = secret_scan.scan(texts[r.doc_id])
        assert r.spans == ",".join(f"{k}:{b}:{e}" for k, b, e, _ in found)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in found) for k in ("assign", "access", "hex"))


def test_guess_spans_lie_in_no_other_span():
    text = "token=Zx8qLw2Vt9Kd password: 'Gh5,Nw1;Rt7:Pv' secret => 0123456789abcdef0123456789abcdef api-key: \"Qm4 Tz8 Jc2 Xb6\" " * 40
    found = secret_scan.scan(text)
    base = [(b, e) for k, b, e, _ in found if k != "guess"]
    guesses = [(b, e) for k, b, e, _ in found if k == "guess"]
    assert guesses and not any(b <= begin and end <= e for begin, end in guesses for b, e in base)


def test_random_values_count_from_eight_characters_on():
    for value in ("x9$Kq!2v", "x9$Kq!2vT", "Zr#8kW%b"):
        text = f'password: "{value}" and more'
        assert [s[:3] for s in secret_scan.scan(text)] == [("guess", 11, 11 + len(value))], value
        assert secret_scan.redacted(text, "[secret]") == 'password: "[secret]" and more'
    assert secret_scan.scan('password: "x9$Kq!2"') == secret_scan.scan("pwd: Password1") == secret_scan.scan("pwd: qwerty2024") == []


def test_prose_and_plain_urls_are_no_secrets():
    plain = [
        '"password": "Please enter your current password again"', "secret: https://docs.example.com/documentation/page-2",
        "token = 'The token (see RFC 6750) is sent by the client.'", 'pwd: "Don\'t write it down, ever!"', "passphrase: 'correct horse battery staple'",
    ]
    for text in plain:
        assert [s for s in secret_scan.scan(text) if s[0] == "guess"] == [], text
    secret = [
        "secret: https://hooks.example.com/services/T00/9f8Xk2LmQ7ZpR4tV", "passphrase = 'zK9!q x7#Gq 29z#' ", 'pwd: "use x9$Kq!2v#Lp as usual"',
        "secret: https://user:x9Kq2vLp7@db.example.com/", 'pwd: "xKqZpWvRtY"',
    ]
    for text in secret:
        assert [s[0] for s in secret_scan.scan(text)] in (["guess"], ["assign", "guess"]), text


def test_planted_values_are_found_and_others_left():
    rng = random.Random(3)
    signs = "abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789!#$%&*"
    words = ["summer", "dragon", "Monkey", "password", "qwerty", "2019", "123456", "aaaa", "love"]
    planted = ["pwd: " + "".join(rng.choice(signs) for _ in range(rng.randint(10, 30))) for _ in range(400)]
    weak = ["pwd: " + "".join(rng.sample(words, 2)) for _ in range(400)]
    found = sum(bool(secret_scan.scan(x)) for x in planted)
    wrong = sum(bool(secret_scan.scan(x)) for x in weak)
    assert found / 400 >= 0.98 and found / (found + wrong) >= 0.98


def test_sequences_that_turn_round_share_a_character():
    spans = {(b, e) for b, e, _ in secret_scan._walks("abcdcba")}
    assert {(0, 4), (3, 7), (4, 7)} <= spans
    assert (1, 7) in {(b, e) for b, e, _ in secret_scan._walks("babcdef")}
    assert secret_scan.guess_log10("abcdefedcba") < 6


def test_dictionary_of_the_caller(spark, documents):
    rows = documents((1, "pwd: 'correcthorsebatterystaple'"), (2, "pwd: x7Gq!29z#Lp0"), (3, None))
    guesses = lambda found: {r.doc_id: [s.kind for s in r.secrets] for r in found.collect()}
    assert guesses(secret_scan.with_secrets(rows)) == {1: ["guess"], 2: ["guess"], 3: []}
    texts = documents(*[(i, "Correct horse, battery STAPLE an x y1z") for i in range(5)], (9, "horse horses"), (10, None))
    ranked = secret_scan.frequent_words(texts, size=5)
    assert [(r.word, r["rank"]) for r in ranked.orderBy("rank").collect()] == [("horse", 1), ("battery", 2), ("correct", 3), ("staple", 4), ("horses", 5)]
    assert guesses(secret_scan.with_secrets(rows, dictionary=ranked)) == {1: [], 2: ["guess"], 3: []}
    assert [r.text for r in secret_scan.redact(rows, dictionary=ranked).orderBy("doc_id").collect()][:2] == ["pwd: 'correcthorsebatterystaple'", "pwd: [secret]"]
    assert guesses(secret_scan.with_secrets(rows, dictionary=ranked.limit(0))) == {1: ["guess"], 2: ["guess"], 3: []}
