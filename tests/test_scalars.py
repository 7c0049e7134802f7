import ipaddress

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from threatloom.functions import scalars as S
from threatloom.functions.addresses import normalize_ip, normalize_ipv4, seed_ip
from threatloom.functions.links import decode_entities, raw_hrefs


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def docs(spark, *values):
    return texts(spark, *values).withColumn("d", F.try_parse_json("t"))


@pytest.mark.parametrize(
    ("body", "expected"),
    [("3.7", 3), ('"3.7"', None), ('" 42 "', 42), ("true", 1), ("null", None), ('""', None), ('"+5"', 5), ("{}", None)],
)
def test_safe_int(spark, body, expected):
    df = docs(spark, f'{{"p":{body}}}')
    assert df.select(S.safe_int(F.col("d"), "$.p")).first()[0] == expected
    assert df.select(S.safe_int(F.col("d"), "$.p", 0)).first()[0] == (expected or 0)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-(2**63), 2**63 - 1).map(str), st.text(max_size=6)), min_size=30, max_size=60))
def test_text_int_agrees_with_int(spark, values):
    def plain(text):
        try:
            number = int(text) if text.isascii() and "_" not in text else None
        except ValueError:
            return None
        return number if number is not None and -(2**63) <= number < 2**63 else None

    values = [v for v in values if v.isascii() and "_" not in v]
    got = [r[0] for r in texts(spark, *values).select(S.text_int(F.col("t"))).collect()]
    assert got == [plain(v) for v in values]


def test_safe_str_and_kinds(spark):
    df = docs(spark, '{"p":true}', '{"p":1.5}', '{"p":null}', "{}", '{"p":{"b":1,"a":2}}')
    got = [r[0] for r in df.select(S.safe_str(F.col("d"), "$.p")).collect()]
    assert got == ["True", "1.5", "", "", '{"a":2,"b":1}']


def test_duplicate_json_keys_keep_the_last(spark):
    assert docs(spark, '{"p":1,"p":2}').select(S.safe_int(F.col("d"), "$.p")).first()[0] == 2


@pytest.mark.parametrize(
    ("text", "expected"), [("0.975", 0.975), ("abc", 0.0), (None, 0.0), ("NaN", 0.0), (" 1e-3 ", 0.001), ("", 0.0)]
)
def test_probability(spark, text, expected):
    assert texts(spark, text).select(S.probability(F.col("t"))).first()[0] == expected


IPS = {
    " 172.16.4.9 ": "172.16.4.9",
    "172.16.4.9:443": "172.16.4.9",
    "172.16.4.9:abc": "172.16.4.9",
    "2001:DB8:0:0:0:0:0:1": "2001:db8::1",
    "010.0.0.1": None,
    "10.0.0.256": None,
    "10.0.0.0/8": None,
    "evil.test": None,
    "evil.test:80": None,
    "": None,
    "1:2": None,
    "::1": "::1",
    "fe80::1%eth0": "fe80::1%eth0",
}


def test_normalize_ip_table(spark):
    got = {r["t"]: r["n"] for r in texts(spark, *IPS, None).select("t", normalize_ip(F.col("t")).alias("n")).collect()}
    assert got == {**IPS, None: None}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(
            st.ip_addresses().map(str),
            st.ip_addresses(v=6).map(lambda a: a.exploded),
            st.from_regex(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", fullmatch=True),
            st.from_regex(r"[0-9a-f:]{3,12}", fullmatch=True),
        ),
        min_size=40,
        max_size=80,
    )
)
def test_normalize_ip_agrees_with_ipaddress(spark, values):
    def plain(text):
        try:
            return str(ipaddress.ip_address(text))
        except ValueError:
            return None

    got = [r[0] for r in texts(spark, *values).select(normalize_ip(F.col("t"))).collect()]
    assert got == [plain(v) for v in values]


def test_ipv4_stays_in_the_jvm(spark):
    plan = texts(spark, "1.2.3.4").select(normalize_ipv4(F.col("t")))._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan


@pytest.mark.parametrize(
    ("record", "expected"),
    [
        ('{"ioc_type":"ip:port","ioc":"172.16.4.9:80"}', "172.16.4.9"),
        ('{"ioc_type":"domain","ioc":"evil.test","ip":"172.16.4.10"}', "172.16.4.10"),
        ('{"ioc_type":"url","ioc":"::1"}', None),
        ('{"ioc_type":"url","ioc":"::1","ip":"::1"}', "::1"),
        ('{"ioc_type":"ipv6","ioc_value":"2001:DB8::1"}', "2001:db8::1"),
        ('{"ioc":5,"host":"10.0.0.3"}', "10.0.0.3"),
        ("{}", None),
    ],
)
def test_seed_ip(spark, record, expected):
    assert docs(spark, record).select(seed_ip(F.col("d"))).first()[0] == expected


def test_paths_and_names(spark):
    assert one(spark, S.path_part(F.lit("a/ingest_date=2026-03-12/f"), "ingest_date")) == "2026-03-12"
    assert one(spark, S.path_part(F.lit("a/xingest_date=1/f"), "ingest_date")) == ""
    formats = {"a.pcap.bz2": "pcap_bz2", "a.pcap": "pcap", "a.tar.gz": "gz", "README": "unknown", ".bashrc": "unknown"}
    for name, expected in formats.items():
        assert one(spark, S.artifact_format(F.lit(name))) == expected
    assert one(spark, S.sanitize_segment(F.lit("__run a//b__"))) == "run_a_b"
    assert one(spark, S.sanitize_segment(F.lit("//"))) == "adhoc"
    assert one(spark, S.sort_date_value(F.lit("2026-03-12"))) == 20260312
    assert one(spark, S.sort_date_value(F.lit("soon"))) == 0


def test_times(spark):
    moment = S.logical_time(F.lit("bad"), F.lit("2026-03-12T23:15:00Z"), F.lit("2020-01-01T00:00:00"))
    assert one(spark, S.ingest_date(moment)) == "2026-03-12"
    assert one(spark, S.hour_partition(moment)) == "23"
    assert one(spark, S.ingest_date(S.logical_time(F.lit("2026-03-12T23:15:00-02:00")))) == "2026-03-13"
    assert one(spark, S.window_bound_text(S.window_start(moment, 24))) == "2026-03-11T23:15:00.000"
    later = S.logical_time(F.lit("2026-03-12T23:15:01.23456Z"))
    assert one(spark, S.duration_seconds(moment, later)) == 1.235
    run = one(spark, S.replay_run_id(moment))
    assert run.startswith("20260312T231500Z-") and len(run) == 16 + 1 + 12


def test_text_helpers(spark):
    assert one(spark, S.error_tail(F.lit("x" * 2000 + "end"))) == "x" * 997 + "end"
    assert one(spark, S.http_status(F.lit("HTTP Error 404: gone"))) == 404
    assert one(spark, S.http_status(F.lit("timeout"))) is None
    for signature, cve in {
        "ET EXPLOIT Log4j CVE-2021-44228": "CVE-2021-44228",
        "et cve_2019_0708 rdp": "CVE-2019-0708",
        "ET TROJAN": None,
    }.items():
        assert one(spark, S.cve_in_signature(F.lit(signature))) == cve
    assert one(spark, S.strip(F.lit(" \x1c a b\t "))) == "a b"
    assert one(spark, S.looks_like_url(F.lit("http://bad host/"))) is False
    assert one(spark, S.looks_like_url(F.lit("https://h/x"))) is True
    assert one(spark, S.message_key(F.lit(""), F.lit(None).cast("string"), F.lit("flow"))) == "flow"
    assert one(spark, S.message_key(F.lit(""), F.lit(""))) is None


def test_manifest_identity(spark):
    df = docs(
        spark,
        '{"relative_landing_path":" a/b ","landing_path":"x"}',
        '{"relative_landing_path":"","landing_path":"/x"}',
        '{"landing_path":null}',
        '{"b":1,"a":2}',
        '{"a":2,"b":1}',
    )
    got = [r[0] for r in df.select(S.manifest_identity(F.col("d"))).collect()]
    assert got[:3] == ["relative::a/b", "landing::/x", "landing::None"]
    assert got[3] == got[4] and got[3].startswith("content::")


PAGE = """
<!-- <a href="comment"> --><script>"<a href='script'>"</script><STYLE><a href=style></STYLE>
<A class=x HREF="a&amp;b">1</a> <a href="" title="href='fake'" href='second'>2</a> <a name=here>3</a>
<abbr href=no>4</abbr> <a
href = "with space">5</a> <a href=bare/>6</a> <a title="x > y" href='q"q'>7</a> <a href="open
"""


def test_links(spark):
    hrefs = texts(spark, PAGE).select(F.posexplode(raw_hrefs(F.col("t"))).alias("pos", "h"))
    got = [r["h"] for r in hrefs.select("pos", decode_entities(F.col("h")).alias("h")).orderBy("pos").collect()]
    assert got == ["a&b", "second", "with space", "bare/", 'q"q']


def test_unclosed_tag_does_not_backtrack(spark):
    page = "<a " + "x" * 200_000 + "'" + "y" * 200_000
    assert texts(spark, page).select(F.size(raw_hrefs(F.col("t")))).first()[0] == 0


def test_url_join(spark):
    base = F.lit("https://h.example/data/sets/index.html")
    for href, expected in {
        "x-42/": "https://h.example/data/sets/x-42/",
        "/root": "https://h.example/root",
        "//other/x": "https://other/x",
        "http://z/": "http://z/",
    }.items():
        assert one(spark, S.url_join(base, F.lit(href))) == expected


def test_first_where(spark):
    items = F.array(F.lit(1), F.lit(5), F.lit(7))
    assert one(spark, S.first_where(items, lambda x: x > 4)) == 5
    assert rows(spark.range(1).select(S.first_where(items, lambda x: x > 9))) == [(None,)]
