import pytest

from bidtrail.functions import useragent as ua
from bidtrail.plans.logview import USER_AGENTS

IPHONE = "Mozilla/5.0 (iPhone; CPU iPhone OS 6_0 like Mac OS X) AppleWebKit/536.26 (KHTML, like Gecko) Version/6.0 Mobile/10A403 Safari/8536.25"
CASES = {
    USER_AGENTS[0]: ("CHROME21", "CHROME", "GOOGLE", None, 21, 0, "WINDOWS_7", "COMPUTER"),
    USER_AGENTS[1]: ("ANDROID_WEBKIT", "ANDROID_WEBKIT", "GOOGLE", 4.0, 4, 0, "ANDROID4", "MOBILE"),
    USER_AGENTS[2]: ("IE8", "IE", "MICROSOFT", 8.0, 8, 0, "WINDOWS_XP", "COMPUTER"),
    USER_AGENTS[3]: ("CHROME21", "CHROME", "GOOGLE", None, 21, 0, "WINDOWS_XP", "COMPUTER"),
    IPHONE: ("MOBILE_SAFARI", "SAFARI", "APPLE", 6.0, 6, 0, "IPHONE", "MOBILE"),
    "Mozilla/5.0 (Windows NT 6.1; rv:21.0) Gecko/20100101 Firefox/21.0": ("FIREFOX21", "FIREFOX", "MOZILLA", 21.0, 21, 0, "WINDOWS_7", "COMPUTER"),
    "Opera/9.80 (Windows NT 6.1) Presto/2.12.388 Version/12.16": ("OPERA12", "OPERA", "OPERA", 12.16, 12, 16, "WINDOWS_7", "COMPUTER"),
    "Mozilla/5.0 (Windows NT 6.3; Trident/7.0; rv:11.0) like Gecko": ("IE11", "IE", "MICROSOFT", 11.0, 11, 0, "WINDOWS_81", "COMPUTER"),
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)": ("BOT", "BOT", "OTHER", 2.1, 2, 1, None, None),
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_8_4) AppleWebKit/536.30.1 Version/6.0.5 Safari/536.30.1": ("SAFARI6", "SAFARI", "APPLE", None, 6, 0, "MAC_OS_X", "COMPUTER"),
    "Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 Chrome/120.0 Safari/537.36 Edg/120.0": ("EDGE120", "EDGE", "MICROSOFT", 120.0, 120, 0, "WINDOWS_10", "COMPUTER"),
    "GOOGLEBOT/3.0": ("BOT", "BOT", "OTHER", 3.0, 3, 0, None, None),
    "something else": (None,) * 8,
    "": (None,) * 8,
}
NAMES = (
    "ua_browser ua_browser_group ua_browser_manufacturer ua_browser_version ua_browser_version_major "
    "ua_browser_version_minor ua_os ua_os_device"
).split()


def test_families(spark):
    df = spark.createDataFrame([(t,) for t in CASES], "user_agent string")
    got = {r["user_agent"]: tuple(r[n] for n in NAMES) for r in ua.add_user_agent_columns(df, with_type=True).collect()}
    assert got == CASES


def test_null_text(spark):
    row = ua.add_user_agent_columns(spark.createDataFrame([(None,)], "user_agent string")).first()
    assert set(row) == {None}


def test_ids_differ_by_browser_and_system(spark):
    df = spark.createDataFrame([(t,) for t in USER_AGENTS], "user_agent string")
    ids = [r["ua_id"] for r in ua.add_user_agent_columns(df).collect()]
    assert len(set(ids)) == 4


def test_distinct_form_is_equal(spark, rows):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*CASES, *CASES, None])], "id int, user_agent string")
    assert rows(ua.add_user_agent_columns(df)) == rows(ua.add_user_agent_columns_by_distinct(df))


@pytest.mark.parametrize("text, expected", [(USER_AGENTS[0], ("CHROME21", "21.0.1180.89", "WINDOWS_7")), ("zzz", ("null",) * 3)])
def test_four_columns(spark, text, expected):
    row = ua.add_four_agent_columns(spark.createDataFrame([(text,)], "_c4 string"), "_c4").first()
    assert (row["browser"], row["browserVersion"], row["operatingSystem"]) == expected
