"""The text anonymiser against a direct Python rendering of its rules."""

import hashlib
import hmac
import random
import re

from pyspark.sql import functions as F

from rowferry.functions import masking as M
from rowferry.operators.masking import anonymize

SEED = "seed"


def h(value):
    return hmac.new(SEED.encode(), value.encode(), hashlib.sha256).hexdigest().upper()[:16]


def masked(spark, *texts, known=()):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["t"] for r in anonymize(df, "t", SEED, known).orderBy("i").collect()]


def test_keyed_hash(spark):
    long_seed = "s" * 100
    for seed in (SEED, long_seed):
        got = spark.range(1).select(M.keyed_hash(F.lit("välue"), seed)).first()[0]
        assert got == hmac.new(seed.encode(), "välue".encode(), hashlib.sha256).hexdigest().upper()[:16]


def test_many_known_values_equal_one_replacement_after_the_other(spark):
    draw = random.Random(3)
    letters = "ab<>\u00e9\\$.\U0001f600 "
    entries = [("".join(draw.choices(letters, k=draw.randint(1, 5))), draw.choice(["a", "ab", "org"])) for _ in range(150)]
    texts = ["", *("".join(draw.choices(letters + "xyz", k=draw.randint(0, 25))) for _ in range(60))]
    unique = dict.fromkeys((v.strip(), label) for v, label in entries if v.strip())
    expected = []
    for text in texts:
        for value, label in sorted(unique, key=lambda entry: -len(entry[0])):
            text = text.replace(value, f"{label}<{M.keyed_hash_text(value, 'seed')}>")
        expected.append(text)
    df = spark.createDataFrame([*enumerate(texts), (999, None)], "i int, t string")
    got = df.select("i", M.mask_known(F.col("t"), entries, "seed").alias("t")).orderBy("i").collect()
    assert [r["t"] for r in got] == [*expected, None]


def test_ten_thousand_known_values(spark):
    entries = [(f"user{i}@example", "user") for i in range(10_000)]
    df = spark.createDataFrame([(f"from user{i}@example to user{i + 1}@example, user and {i}",) for i in range(0, 9_000, 100)], "t string")
    got = [r["t"] for r in df.select(M.mask_known(F.col("t"), entries, "s").alias("t")).collect()]

    def hidden(i):
        return f"user<{M.keyed_hash_text(f'user{i}@example', 's')}>"

    assert sorted(got) == sorted(f"from {hidden(i)} to {hidden(i + 1)}, user and {i}" for i in range(0, 9_000, 100))


def test_known_values(spark):
    got = masked(spark, "user bob@x at acme", "0015g00000ABCDE stays", known=[("acme", "org"), ("0015g00000ABCDE", "org")])
    assert got == [f"user bob@x at org<{h('acme')}>", "0015g00000ABCDE stays"]


def test_secrets(spark):
    got = masked(spark, 'password: "s3cret"', "x token=abc, y", "sent Bearer abc.def", "no key here")
    assert "s3cret" not in got[0] and got[0].startswith("password: ")
    assert got[1] == f"x token=token<{h('abc')}>, y"
    assert got[2] == f"sent Bearer bearer<{h('abc.def')}>"
    assert got[3] == "no key here"


def test_places(spark):
    got = masked(spark, "mail a.b@c.org now", "see https://x.y/z) end", "host a-b.example.com!", r"in C:\tmp\f.txt ok", r"\\srv\share\f ok")
    assert got == [
        f"mail email<{h('a.b@c.org')}> now",
        f"see url<{h('https://x.y/z')}>) end",
        f"host domain<{h('a-b.example.com')}>!",
        rf"in path<{h(r'C:' + chr(92) + 'tmp' + chr(92) + 'f.txt')}> ok",
        f"path<{h(chr(92) * 2 + 'srv' + chr(92) + 'share' + chr(92) + 'f')}> ok",
    ]


def test_queries(spark):
    got = masked(
        spark,
        "Query string: SELECT Id FROM A WHERE Name IN ('Acme', '001000000000000AAA') AND X__c = 'v'",
        "no query: Name IN ('Acme')",
    )
    assert got[0] == (
        f"Query string: SELECT Id FROM A WHERE Name IN ('soql<{h('Acme')}>', '001000000000000AAA') AND X__c = 'soql<{h('v')}>'"
    )
    assert got[1] == "no query: Name IN ('Acme')"


def test_answers_and_pairs(spark):
    got = masked(spark, "PROMPT ANSWER: yes please", "[1] {Account} - name: Acme Ltd.", "Prompt answer:  ")
    assert got == [f"PROMPT ANSWER: prompt<{h('yes please')}>", f"[1] {{Account}} - name: value<{h('Acme Ltd')}>.", "Prompt answer:  "]


def test_bypass(spark):
    got = masked(spark, "@@NO_ANON@@mail a@b.org", "[STACK TRACE] a@b.org", "x\n   at foo (b.js:1) a@b.org", 'Value mapping rule "a@b.org"', None)
    assert got == ["mail a@b.org", "[STACK TRACE] a@b.org", "x\n   at foo (b.js:1) a@b.org", 'Value mapping rule "a@b.org"', None]


def test_long_quoted_text_does_not_use_up_the_stack(spark):
    body = "x y " * 50_000
    got = masked(spark, f"query string: select a from b where N in ('{body}')")
    assert got == [f"query string: select a from b where N in ('soql<{h(body.strip())}>')"]


def test_same_tokens_on_every_run(spark):
    text = "a@b.org and a@b.org"
    first, second = masked(spark, text), masked(spark, text)
    assert first == second and len(set(re.findall("email<.*?>", first[0]))) == 1


def test_a_value_behind_a_long_name_is_masked(spark):
    name = "n" * 500
    assert masked(spark, f"[x] {{Account}} - {name}: hidden value") == [f"[x] {{Account}} - {name}: value<{h('hidden value')}>"]
