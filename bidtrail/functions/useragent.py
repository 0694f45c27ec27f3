"""User-agent text to browser and operating-system columns.

The rules cover the browser and system families listed below; any other text gives nulls.  They are native
expressions, so a scan computes the columns without a shuffle and without Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import UA_COLUMNS

# Browser rules, tried in this order; the first whose marks all occur in the text, in upper or lower
# case, wins.
# (name, marks, text before the version, group, name carries the major version, type, manufacturer, rendering engine)
BROWSERS = [
    ("BOT", ["bot"], "bot/", "BOT", False, "ROBOT", "OTHER", "OTHER"),
    ("SPIDER", ["spider"], "spider/", "BOT", False, "ROBOT", "OTHER", "OTHER"),
    ("EDGE", ["Edge/"], "Edge/", "EDGE", True, "WEB_BROWSER", "MICROSOFT", "EDGE_HTML"),
    ("EDGE", ["Edg/"], "Edg/", "EDGE", True, "WEB_BROWSER", "MICROSOFT", "BLINK"),
    ("OPERA", ["OPR/"], "OPR/", "OPERA", True, "WEB_BROWSER", "OPERA", "BLINK"),
    ("OPERA", ["Opera", "Version/"], "Version/", "OPERA", True, "WEB_BROWSER", "OPERA", "PRESTO"),
    ("OPERA", ["Opera/"], "Opera/", "OPERA", True, "WEB_BROWSER", "OPERA", "PRESTO"),
    ("OPERA", ["Opera "], "Opera ", "OPERA", True, "WEB_BROWSER", "OPERA", "PRESTO"),
    ("IE", ["MSIE "], "MSIE ", "IE", True, "WEB_BROWSER", "MICROSOFT", "TRIDENT"),
    ("IE", ["Trident/", "rv:"], "rv:", "IE", True, "WEB_BROWSER", "MICROSOFT", "TRIDENT"),
    ("FIREFOX", ["Firefox/"], "Firefox/", "FIREFOX", True, "WEB_BROWSER", "MOZILLA", "GECKO"),
    ("CHROME_IOS", ["CriOS/"], "CriOS/", "CHROME", True, "MOBILE_BROWSER", "GOOGLE", "WEBKIT"),
    ("CHROME", ["Chrome/"], "Chrome/", "CHROME", True, "WEB_BROWSER", "GOOGLE", "WEBKIT"),
    ("ANDROID_WEBKIT", ["Android", "Version/", "Safari"], "Version/", "ANDROID_WEBKIT", False, "MOBILE_BROWSER", "GOOGLE", "WEBKIT"),
    ("MOBILE_SAFARI", ["Mobile/", "Safari"], "Version/", "SAFARI", False, "MOBILE_BROWSER", "APPLE", "WEBKIT"),
    ("SAFARI", ["Version/", "Safari"], "Version/", "SAFARI", True, "WEB_BROWSER", "APPLE", "WEBKIT"),
]

# Operating-system rules, tried in this order.
# (name, marks, readable name, device, group, manufacturer)
SYSTEMS = [
    ("WINDOWS_PHONE", ["Windows Phone"], "Windows Phone", "MOBILE", "WINDOWS", "MICROSOFT"),
    ("WINDOWS_10", ["Windows NT 10.0"], "Windows 10", "COMPUTER", "WINDOWS", "MICROSOFT"),
    ("WINDOWS_81", ["Windows NT 6.3"], "Windows 8.1", "COMPUTER", "WINDOWS", "MICROSOFT"),
    ("WINDOWS_8", ["Windows NT 6.2"], "Windows 8", "COMPUTER", "WINDOWS", "MICROSOFT"),
    ("WINDOWS_7", ["Windows NT 6.1"], "Windows 7", "COMPUTER", "WINDOWS", "MICROSOFT"),
    ("WINDOWS_VISTA", ["Windows NT 6.0"], "Windows Vista", "COMPUTER", "WINDOWS", "MICROSOFT"),
    ("WINDOWS_2003", ["Windows NT 5.2"], "Windows Server 2003", "COMPUTER", "WINDOWS", "MICROSOFT"),
    ("WINDOWS_XP", ["Windows NT 5.1"], "Windows XP", "COMPUTER", "WINDOWS", "MICROSOFT"),
    ("WINDOWS_2000", ["Windows NT 5.0"], "Windows 2000", "COMPUTER", "WINDOWS", "MICROSOFT"),
    ("WINDOWS", ["Windows"], "Windows", "COMPUTER", "WINDOWS", "MICROSOFT"),
    ("ANDROID2", ["Android 2"], "Android 2.x", "MOBILE", "ANDROID", "GOOGLE"),
    ("ANDROID3", ["Android 3"], "Android 3.x", "TABLET", "ANDROID", "GOOGLE"),
    ("ANDROID4", ["Android 4", "Mobile"], "Android 4.x", "MOBILE", "ANDROID", "GOOGLE"),
    ("ANDROID4_TABLET", ["Android 4"], "Android 4.x Tablet", "TABLET", "ANDROID", "GOOGLE"),
    ("ANDROID", ["Android"], "Android", "MOBILE", "ANDROID", "GOOGLE"),
    ("IPHONE", ["iPhone"], "iOS (iPhone)", "MOBILE", "IOS", "APPLE"),
    ("IPAD", ["iPad"], "iOS (iPad)", "TABLET", "IOS", "APPLE"),
    ("MAC_OS_X", ["Mac OS X"], "Mac OS X", "COMPUTER", "MAC_OS_X", "APPLE"),
    ("LINUX", ["Linux"], "Linux", "COMPUTER", "LINUX", "OTHER"),
]

VERSION = r"^\d+(?:\.\d+)*"


# The expressions are SQL texts: built from the tables in one piece, they reach Spark in a few calls.


def _first_rule(rules: list[tuple]) -> str:
    """Number (from 0) of the first rule whose marks all occur in _text; null if there is none."""
    cases = [
        "WHEN " + " AND ".join(f"contains(_text, '{mark.lower()}')" for mark in rule[1]) + f" THEN {number}"
        for number, rule in enumerate(rules)
    ]
    return f"CASE {' '.join(cases)} END"


def _rules(rules: list[tuple]) -> str:
    """The rules without their marks as a constant array of structs with fields f0, f2, ..."""
    def cell(value) -> str:
        return str(value).lower() if isinstance(value, bool) else f"'{value}'"

    rows = [", ".join(f"{cell(v)} AS f{i}" for i, v in enumerate(rule) if not isinstance(v, list)) for rule in rules]
    return f"array({', '.join(f'struct({row})' for row in rows)})"


def _with_parts(df: DataFrame, source: str) -> DataFrame:
    """Append the matching rules (_browser, _system, and as structs _b, _s) and the version text (_version).

    Each is worked out once, in projections of their own: Spark keeps them apart because each reads the one below more
    than once.  The lambda around lower() is there because Spark ends the compiled method of a stage at a lambda:
    the rules and the joins below them together would make a method too long for the JVM to compile.
    """
    lowered = df.selectExpr("*", f"get(transform(array(`{source}`), t -> lower(t)), 0) AS _text")
    matched = lowered.selectExpr("*", f"{_first_rule(BROWSERS)} AS _browser", f"{_first_rule(SYSTEMS)} AS _system")
    found = matched.selectExpr("*", f"get({_rules(BROWSERS)}, _browser) AS _b", f"get({_rules(SYSTEMS)}, _system) AS _s")
    version = f"CASE WHEN _browser IS NOT NULL THEN nullif(regexp_extract(split_part(_text, lower(_b.f2), 2), r'{VERSION}', 0), '') END"
    return found.selectExpr("*", f"{version} AS _version")


def _ua_columns() -> dict[str, str]:
    """Every user-agent column, from the parts."""
    major, minor, third = (f"split_part(_version, '.', {part})" for part in (1, 2, 3))
    return {
        "ua_browser": f"concat(_b.f0, CASE WHEN _b.f4 THEN coalesce({major}, '') ELSE '' END)",
        "ua_browser_type": "_b.f5",
        "ua_browser_group": "_b.f3",
        "ua_browser_manufacturer": "_b.f6",
        "ua_browser_rendering_engine": "_b.f7",
        # Only 'N' and 'N.N' are tried: a failing conversion of each row would cost more than all the rest.
        "ua_browser_version": f"CASE WHEN {third} = '' THEN try_cast(_version AS double) END",
        "ua_browser_version_minor": f"try_cast(nullif({minor}, '') AS int)",
        "ua_browser_version_major": f"try_cast({major} AS int)",
        # A stable number of the (browser rule, major version, system rule) triple.
        "ua_id": f"""CASE WHEN _browser IS NOT NULL OR _system IS NOT NULL THEN (coalesce(_browser, -1) + 1) * 10000000
            + pmod(coalesce(try_cast({major} AS int), 0), 100000) * 100 + coalesce(_system, -1) + 1 END""",
        "ua_os": "_s.f0",
        "ua_os_name": "_s.f2",
        "ua_os_device": "_s.f3",
        "ua_os_group": "_s.f4",
        "ua_os_manufacturer": "_s.f5",
    }


def add_user_agent_columns(df: DataFrame, source: str = "user_agent", with_type: bool = False) -> DataFrame:
    """Append the user-agent columns (plus ua_browser_type if asked).

    ua_browser_version is null unless the version is a plain number.
    """
    columns = _ua_columns()
    wanted = [*UA_COLUMNS, "ua_browser_type"] if with_type else UA_COLUMNS
    kept = [f"`{name}`" for name in df.columns]
    return _with_parts(df, source).selectExpr(*kept, *[f"{columns[name]} AS {name}" for name in wanted])


def add_user_agent_columns_by_distinct(df: DataFrame, source: str = "user_agent") -> DataFrame:
    """The same columns, worked out once per distinct text and joined back.

    Pays off only where the distinct texts are few enough for Spark to broadcast them; otherwise the join
    moves every row, so the jobs here use add_user_agent_columns.
    """
    texts = df.select(source).where(F.col(source).isNotNull()).distinct()
    return df.join(add_user_agent_columns(texts, source), source, "left").select(*df.columns, *UA_COLUMNS)


def add_four_agent_columns(df: DataFrame, source: str) -> DataFrame:
    """browser, browserVersion, id and operatingSystem of a column as text, with 'null' for a miss."""
    columns = _ua_columns()
    texts = {
        "browser": columns["ua_browser"],
        "browserVersion": "_version",
        "id": f"cast({columns['ua_id']} AS string)",
        "operatingSystem": columns["ua_os"],
    }
    kept = [f"`{name}`" for name in df.columns]
    return _with_parts(df, source).selectExpr(*kept, *[f"coalesce({c}, 'null') AS {n}" for n, c in texts.items()])
