import random
import re

import pytest

from rawstrata.llm import op8_quality_rules, op9_secret_scan, op10_url_filters


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(documents):
    draw = random.Random(1)
    texts = ["".join(draw.choice("ab#é日 \n\t\x0b") for _ in range(draw.randrange(0, 160))) for _ in range(80)]
    texts += ["a b c a b c a b c a b c", "x " * 40, "a b c d a b c", "a\nb\na\n \n \nb", "", None]
    frame = documents([(i, t, "en", "a", 0) for i, t in enumerate(texts)])
    got = {r.doc_id: tuple(r)[1:6] for r in op8_quality_rules.quality_rules(frame).collect()}
    assert got == {i: brute_counts(t) for i, t in enumerate(texts)}


def test_cutoffs_follow_language_and_source(documents):
    """Long words are normal in one language and stand out in another; symbols likewise."""
    draw = random.Random(2)

    def text(letters, mark=""):
        return " ".join("".join(draw.choice("abcdefgh") for _ in range(letters)) + mark for _ in range(80))

    rows = [(i, text(12), "long", "a", 0) for i in range(150)]
    rows += [(200 + i, text(4), "short", "b", 0) for i in range(150)]
    rows += [(400, text(12), "short", "b", 0), (401, text(4, "###"), "short", "b", 0)]
    rows += [(500 + i, text(4, "##"), "short", "c", 0) for i in range(150)]
    got = {r.doc_id: r.kept for r in op8_quality_rules.quality_rules(documents(rows)).collect()}
    assert {i for i, kept in got.items() if not kept} == {400, 401}


@pytest.mark.parametrize("share", [30, 45, 60])
def test_junk_in_one_source_does_not_switch_the_rule_off(documents, share):
    """Against documents with every second line repeated, in a source of which they are a large
    part; beyond half of it the language's other sources decide."""
    draw = random.Random(share)

    def text(junk):
        lines = [" ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(9)) for _ in range(20)]
        if junk:
            lines[1::2] = [lines[0][:11]] * 10
        return "\n".join(lines)

    bad = {i for i in range(300) if i % 100 < share}
    rows = [(i, text(i in bad), "en", "a", 0) for i in range(300)]
    rows += [(1000 + i, text(False), "en", "b", 0) for i in range(300)]
    got = {r.doc_id: r for r in op8_quality_rules.quality_rules(documents(rows)).collect()}
    assert {i for i, r in got.items() if not r.kept} == bad
    assert not any(r.base_failed for r in got.values())


def test_long_words_in_part_of_a_source(documents):
    draw = random.Random(7)

    def text(size):
        return " ".join("".join(draw.choice("abcdefgh") for _ in range(size)) for _ in range(80))

    rows = [(i, text(14 if i % 10 < 4 else 5), "en", "a", 0) for i in range(300)]
    rows += [(1000 + i, text(1 if i % 10 < 4 else 5), "en", "b", 0) for i in range(300)]
    got = {r.doc_id: r.kept for r in op8_quality_rules.quality_rules(documents(rows)).collect()}
    assert all(kept == (i % 10 >= 4) for i, kept in got.items())


def test_sql_judges_junk_alike(spark, documents):
    import duckdb

    draw = random.Random(9)
    rows = []
    for i in range(700):
        lines = [" ".join(draw.choice("abcdefgh") * draw.randrange(2, 9) for _ in range(9)) for _ in range(12)]
        lang, source, junk = [("en", "a", 45), ("en", "b", 5), ("de", "c", 70), (None, "d", 30)][i % 4]
        if draw.randrange(100) < junk:
            lines[1::2] = ["some words"] * 6
        rows.append((i, "\n".join(lines), lang, source, 0))
    frame = documents(rows)
    connection = duckdb.connect()
    connection.register("documents", frame.toPandas())
    columns = "doc_id n_words n_dup_lines n_repeat_words base_failed kept".split()
    want = connection.sql(f"SELECT {', '.join(columns)} FROM ({op8_quality_rules.SQL})").fetchall()
    got = [tuple(r) for r in op8_quality_rules.quality_rules(frame).select(*columns).collect()]
    assert sorted(got) == sorted(want)


def test_quality_rules_on_odd_rows(odd_documents):
    rows = op8_quality_rules.quality_rules(odd_documents).collect()
    assert len(rows) == 10 and all(r.kept is not None and not (r.kept and r.base_failed) for r in rows)
    assert op8_quality_rules.quality_rules(odd_documents.limit(0)).count() == 0


HEX = "0123456789abcdef"


@pytest.fixture
def leaky(documents):
    draw = random.Random(3)

    def run(letters, count):
        return "".join(draw.choice(letters) for _ in range(count - 1)) + "7"

    rows, truth = [], {}
    for i in range(240):
        value, before = [
            (run(HEX, 40), 'my token = "'),
            (run("abcdefXYZ0123456789", 32), "password: "),
            (run("0123456789", 16), "order "),
            (run(HEX, 40), "commit "),
        ][i % 4]
        truth[i] = i % 4 < 2
        rows.append((i, f"some calm words {before}{value} and more", "en", "a", 60))
    return documents(rows), truth


def test_secrets_are_told_from_other_long_strings(leaky):
    docs, truth = leaky
    got = {r.doc_id: r.is_secret for r in op9_secret_scan.scan(docs).collect()}
    assert got == truth


def test_scan_in_a_session_that_has_observed_a_metric(leaky, spark):
    from pyspark.sql import Observation, functions as F

    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    docs, truth = leaky
    assert op9_secret_scan.scan(docs).filter("is_secret").count() == sum(truth.values())


def test_a_labelled_table_is_learned(leaky):
    docs, truth = leaky
    labelled = docs.sparkSession.createDataFrame(
        [(i, 0, int(not is_secret)) for i, is_secret in truth.items()], "doc_id long, number int, label int"
    )
    got = {r.doc_id: r.is_secret for r in op9_secret_scan.scan(docs, labelled=labelled).collect()}
    assert got == {i: not t for i, t in truth.items()}


SECRETS = {
    "short password": "password: Hunter{}x9",
    "short token": 'token: "abc12{}"',
    "letters only": 'api_key = "abcdefgh{}ijklmnopqrstuvwx"',
    "vendor without digits": "AKIAQWERTYUIOPASDF{}",
    "name in front": "API_KEY=abcdefghABCDEFGH0123456789{}",
}


def test_secrets_of_other_kinds(leaky, spark):
    """Short ones, ones without digits, and ones whose name is joined to them by an equals sign."""
    docs, truth = leaky
    letters = "KLMNPQRSTU"
    rows, secret = [], {}
    for k, (kind, form) in enumerate(SECRETS.items()):
        for n in range(10):
            i = 1000 + 10 * k + n
            digit_free = kind in ("letters only", "vendor without digits")
            shown = form.format(letters[n] * 2 if digit_free else n)
            rows.append((i, f"some calm words {shown} and more", "en", "a", 60, 7, "x"))
            secret[i] = re.split("[ =\"]+", shown.strip('"'))[-1]
    for n in range(10):
        word = "".join(chr(97 + (7 * n + j * j) % 26) for j in range(8))
        rows.append((2000 + n, f"the secret: {word} and time", "en", "a", 60, 7, "x"))
    every = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    found = {}
    for r in op9_secret_scan.scan(every).collect():
        found.setdefault(r.doc_id, []).append((r.value, r.is_secret))
    for i, value in secret.items():
        assert found[i] == [(value, True)]
    for n in range(10):
        assert not any(is_secret for _, is_secret in found.get(2000 + n, []))
    assert {i: found[i][0][1] for i in truth} == truth


def test_candidates_equal_a_plain_search(documents):
    """Long runs with a digit, by a search over all runs of key characters."""
    draw = random.Random(11)
    texts = ["".join(draw.choice("aZ9 /+-_.\"") * draw.randrange(1, 4) for _ in range(60)) for _ in range(60)]
    frame = documents([(i, t, "en", "a", 0) for i, t in enumerate(texts)])
    got = {}
    for r in op9_secret_scan.findings(frame, "doc_id", "text").collect():
        got.setdefault(r.doc_id, []).append((r.number, r.value))
    for i, text in enumerate(texts):
        runs = [x for x in re.findall(r"[A-Za-z0-9+/_\-]+", text) if len(x) >= 16 and re.search("[0-9]", x)]
        assert [v for _, v in sorted(got.get(i, []))] == runs


def test_plain_cases_label_the_same_value_elsewhere(documents, spark):
    value = "9f" * 12
    frame = documents(
        [(1, f'token = "{value}"', "en", "a", 0), (2, f"he saw {value} there", "en", "a", 0),
         (3, f"commit {'8e' * 12}", "en", "a", 0), (4, f"then {'8e' * 12} too", "en", "a", 0),
         (5, f"or {'7d' * 12}", "en", "a", 0)]
    )
    found = op9_secret_scan.with_features(op9_secret_scan.findings(frame, "doc_id", "text"))
    labels = {r.doc_id: r.label for r in op9_secret_scan.labels_of_values(found).collect()}
    assert labels == {1: 1.0, 2: 1.0, 3: 0.0, 4: 0.0, 5: None}


def test_redaction(leaky):
    docs, truth = leaky
    before = {r.doc_id: r.text for r in docs.collect()}
    rows = op9_secret_scan.redact(docs).collect()
    assert len(rows) == len(before)
    for r in rows:
        assert ("<SECRET>" in r.text) == truth[r.doc_id]
        assert r.n_chars == (len(r.text) if truth[r.doc_id] else 60) and r.score == 7
        assert truth[r.doc_id] or r.text == before[r.doc_id]


def test_neighbours_of_several_findings(documents):
    a, b = "a" * 20 + "1", "b" * 20 + "2"
    frame = documents([(1, f"x {a} mid {b}{b} end {a}", "en", "a", 0)])
    rows = sorted(op9_secret_scan.scan(frame).collect(), key=lambda r: r.number)
    assert [(r.value, r.before) for r in rows] == [(a, "x "), (b + b, " mid "), (a, " end ")]


def test_secrets_in_odd_rows(odd_documents):
    rows = op9_secret_scan.scan(odd_documents).collect()
    assert [(r.doc_id, r.value) for r in rows] == [(8, "0123456789abcdef0123456789abcdef")]
    assert op9_secret_scan.redact(odd_documents).count() == 10
    assert op9_secret_scan.scan(odd_documents.limit(0)).count() == 0


def verdicts(spark, urls, **more):
    frame = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    return {r.page_id: r for r in op10_url_filters.url_filter(frame, **more).collect()}


def test_parts_and_rules(spark):
    urls = [
        "https://WWW.Example.ORG/es/a?x#y", "http://example.org/en/1234", "http://badexample.org/es/1",
        "ftp://a.fr.com/fr/x", "x://shop.com/de/q", "http://org/", "http://a.org", "no url", None,
        "http://a.net?p=/q", "://b.net/p#?", "http://a.org/b://c.com/de/",
    ]
    got = verdicts(spark, urls)
    want = [
        ("www.example.org", "/es/a", "example.org/es/", "block"),
        ("example.org", "/en/1234", "example.org/en/1", "block"),
        ("badexample.org", "/es/1", "org/", "allow"),
        ("a.fr.com", "/fr/x", "com/fr/", "allow"),
        ("shop.com", "/de/q", "com/de/", "block"),
        ("org", "/", "org/", "allow"),
        ("a.org", "", None, None),
        ("", "", None, None),
        ("", "", None, None),
        ("a.net", "", None, None),
        ("b.net", "/p", None, None),
        ("a.org", "/b://c.com/de/", "org/", "allow"),
    ]
    for i, (host, path, rule, verdict) in enumerate(want):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict in ((verdict,) if verdict else ("allow", "block"))


def test_templates_learn_from_labelled_pages(spark):
    """Variable segments become wildcards; branches with other shares stay apart."""
    rules = tuple(op10_url_filters.Rule(v, "a.com", f"/{d}/{n}") for v, d in (("block", "bad"), ("allow", "good")) for n in range(10, 50))
    urls = [f"http://a.com/{d}/{n}" for d in ("bad", "good") for n in range(10, 99)]
    got = verdicts(spark, urls, rules=rules)
    for i, url in enumerate(urls):
        assert got[i].template == ("/bad/*" if "/bad/" in url else "/good/*")
        assert got[i].verdict == ("block" if "/bad/" in url else "allow")


def test_branches_below_four_levels(spark):
    """Deep branches with other shares stay apart, and unlabelled pages take their own's."""
    at = "a.com"
    deep = {"/a/b/c/spam": "block", "/a/b/c/news": "allow", "/2024/05/x/y/z/spam": "block", "/2024/05/x/y/z/news": "allow"}
    rules = tuple(op10_url_filters.Rule(v, at, f"{p}/{n}") for p, v in deep.items() for n in range(10, 50))
    urls = [f"http://{at}{p}/{n}" for p in deep for n in range(10, 99)] + [f"http://{at}/a", f"http://{at}"]
    got = verdicts(spark, urls, rules=rules)
    for i, url in enumerate(urls[:-2]):
        assert got[i].verdict == ("block" if "spam" in url else "allow")
        assert got[i].template.split("/")[-2:] == ["spam" if "spam" in url else "news", "*"]
        assert got[i].template.count("/") == got[i].path.count("/")
    assert len(got) == len(urls) and got[len(urls) - 1].template == ""


def test_a_path_of_two_thousand_segments_ends_at_once(spark):
    import time

    long = "/" + "/".join(f"s{chr(97 + i % 26)}" for i in range(2000))
    urls = [f"http://a.com/{d}/{n}" for d in ("bad", "good") for n in range(10, 60)]
    urls += [f"http://a.com{long}", f"http://b.com{long}", f"http://a.com/bad{long}"]
    rules = tuple(op10_url_filters.Rule(v, "a.com", f"/{d}/{n}") for v, d in (("block", "bad"), ("allow", "good")) for n in range(10, 50))
    began = time.monotonic()
    got = verdicts(spark, urls, rules=rules)
    assert time.monotonic() - began < 60
    assert got[100].template == got[101].template == "/*" * 2000
    assert got[102].template == "/bad" + "/*" * 2000 and got[102].verdict == "block"


def test_alike_branches_merge(spark):
    rules = (op10_url_filters.Rule("allow", "a.com", "/"),)
    got = verdicts(spark, [f"http://a.com/{w}/x" for w in ("red", "blue", "green") for _ in range(5)], rules=rules)
    assert {r.template for r in got.values()} == {"/*/*"}


def test_no_pages(spark):
    assert verdicts(spark, ["http://a.org/"])[0].verdict == "allow"
    frame = spark.createDataFrame([], "page_id long, url string")
    assert op10_url_filters.url_filter(frame).count() == 0
