"""Text, URL and hash functions (inventory X1-X30, F5-F10). Pure Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import Cols, _c

#: URL patterns that are skipped. The last six ask for a literal backslash, as defined, and so never match.
SKIPPED_URLS = (
    "/tag/", "/tags/", "/category/", "/author/", "/feed/?$", "/wp-json", "/privacy", "/terms", "/cookie", "/login", "/signup", "/register", "/cart", "/checkout",
    r"facebook\\.com", r"instagram\\.com", r"x\\.com", r"twitter\\.com", r"youtube\\.com", r"tiktok\\.com",
)
#: Lines that are dropped. Three are in capitals, as defined, and so never match a lowered line.
NOISE_LINES = (
    "^menu$", "^navigation$", "^main menu$", "^skip to content$", "^cookie( policy| settings)?$", "^privacy policy$", "^terms( of service)?$", "^all rights reserved", "^copyright", "^subscribe$",
    "^newsletter$", "^back to top$", "^follow us$", "^share( this)?$", "^home$", "^about$", "^contact$", "^登入$", "^註冊$", "^主頁$", "^首頁$", "^返回頂部$", "^私隱政策$", "^服務條款$", "^版權所有$", "^更多$",
    "^下一頁$", "^上一頁$", "^廣告$", "^贊助內容$", "即日起", "可享", "優惠", "立即登記", "立即報名", "立即申請", "立即預約", "立即下載", "立即訂閱", "立即購買", "立即註冊", "立即登入", "立即參加",
    "MoneyHero", "推廣", "限時優惠", "優惠碼", "迎新禮品", "送總值", "Zurich", "WeLend", "蘇黎世",
)
#: Keywords of the two categories, looked for in this order.
PROCESS_TERMS = ("stamp duty", "ssd", "bsd", "mortgage", "legal", "tenancy agreement", "rental", "conveyancing", "buying process")
DISTRICT_TERMS = ("district", "estate", "neighborhood", "mtr", "school net", "pet-friendly", "tseung kwan o", "sai kung")
#: Query parameters that only track.
TRACKING = r"^(utm_[^=]*|fbclid|gclid|msclkid|igshid|mc_cid|mc_eid)(=|$)"


def strip(x: Cols) -> Column:
    """White space of any script off both ends."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def collapse(x: Cols) -> Column:
    """Runs of white space become one space."""
    return strip(F.regexp_replace(_c(x), r"(?U)\s+", " "))


def normalise_price(x: Cols) -> Column:
    """Currency and period words go."""
    out = _c(x)
    for word in ("HK$", "$", ",", "港元", "/月", "每月"):
        out = F.replace(out, F.lit(word), F.lit(""))
    return collapse(out)


def query_tokens(x: Cols) -> Column:
    """Lower-case tokens of two characters or more."""
    return F.filter(F.split(F.lower(_c(x)), r"[\s,.;:!?/|、，。；：！？／｜]+"), lambda t: F.length(t) >= 2)


def lines(x: Cols) -> Column:
    """Normalised, non-empty lines."""
    return F.filter(F.transform(F.split(_c(x), r"\R"), collapse), lambda t: t != "")


def sanitise(x: Cols) -> Column:
    """Markdown, script links, entities and blank lines, in order; null is empty."""
    out = F.coalesce(_c(x), F.lit(""))
    for pattern, by in ((r"(?d)!\[.*?\]\(.*?\)", ""), (r"(?d)\[(.*?)\]\(.*?\)", "$1"), (r"(?i)javascript:\s*void\(0\)", ""), (r"(?i)\(\s*javascript:\s*void\(0\)\s*\)", "")):
        out = F.regexp_replace(out, pattern, by)
    for entity, by in (("&nbsp;", " "), ("&amp;", "&"), ("&middot;", "·")):
        out = F.replace(out, F.lit(entity), F.lit(by))
    return strip(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def denoise(x: Cols) -> Column:
    """Noise lines and lines of up to two characters go, then repeated ones."""
    noise = "|".join(f"(?:{p})" for p in NOISE_LINES)
    kept = F.filter(lines(x), lambda t: ~F.lower(t).rlike(noise) & (F.length(t) > 2))
    return F.array_join(F.array_distinct(kept), "\n")


def _once(value: Column, of) -> Column:
    """``of(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), of)[0]


def quality_reason(x: Cols, least_lines: int, least_chars: int, least_unique: float, most_navigation: float = 1.0) -> Column:
    """the first reason to reject a text, or ok; the lines are cut once."""

    def reason(found: Column) -> Column:
        n = F.greatest(F.lit(1), F.size(found))
        return (
            F.when(F.size(found) < max(1, least_lines), "too few lines")
            .when(F.length(_c(x)) < max(1, least_chars), "too short")
            .when(F.size(F.array_distinct(found)) / n < least_unique, "low unique-line ratio")
            .when(_navigating(found) / n > most_navigation, "too many navigation lines")
            .otherwise("ok")
        )

    return F.when(strip(F.coalesce(_c(x), F.lit(""))) == "", "empty text").otherwise(_once(lines(x), reason))


def _navigating(found: Column) -> Column:
    return F.size(F.filter(found, lambda t: F.lower(t).rlike("|".join(NAV_WORDS))))


def category(url: Cols, title: Cols, content: Cols) -> Column:
    """By keywords, the legal process first."""
    text = F.lower(F.concat_ws("\n", F.coalesce(_c(url), F.lit("")), F.coalesce(_c(title), F.lit("")), F.substring(F.coalesce(_c(content), F.lit("")), 1, 2000)))

    def has(terms: tuple[str, ...]) -> Column:
        out = F.lit(False)
        for t in terms:
            out = out | text.contains(t)
        return out

    return F.when(has(PROCESS_TERMS), "PROCESS_LAW").when(has(DISTRICT_TERMS), "DISTRICT_ESTATE").otherwise("GENERAL")


def skip_url(x: Cols) -> Column:
    """F5."""
    return _c(x).rlike("(?i)" + "|".join(f"(?:{p})" for p in SKIPPED_URLS))


def strip_tracking(url: Cols) -> Column:
    """The URL without tracking parameters."""
    u = _c(url)
    base, fragment = F.regexp_extract(u, r"^([^#]*)", 1), F.regexp_extract(u, r"(#.*)$", 1)
    path, query = F.regexp_extract(base, r"^([^?]*)", 1), F.regexp_extract(base, r"\?(.*)$", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)), "&")
    return F.concat(path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""), fragment)


#: Fixed value: what an address in a text looks like.
ADDRESS = r"https?://[^\s)\]>\"']+"


def strip_tracking_in_text(x: Cols) -> Column:
    """A text with the tracking parameters of every address in it gone."""
    between, urls = F.split(_c(x), ADDRESS, -1), F.regexp_extract_all(_c(x), F.lit(ADDRESS), F.lit(0))
    bare = F.concat(F.transform(urls, strip_tracking), F.array(F.lit("")))
    return F.array_join(F.zip_with(between, bare, lambda a, b: F.concat(a, b)), "")


def normalise_link(link: Cols, host: str) -> Column:
    """Absolute form without a fragment."""
    bare = F.element_at(F.split(_c(link), "#"), 1)
    return F.when(bare.startswith("//"), F.concat(F.lit("https:"), bare)).when(bare.startswith("/"), F.concat(F.lit(host), bare)).otherwise(bare)


def source_id(url: Cols) -> Column:
    """The last non-empty part of the path, without its extension, or its trailing number after a dash."""
    path = F.regexp_extract(_c(url), r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    part = F.regexp_replace(F.coalesce(F.element_at(F.filter(F.split(path, "/"), lambda p: p != ""), -1), F.lit("")), r"\.[a-z]+$", "")
    number = F.regexp_extract(part, r"-(\d+)$", 1)
    return F.when(number != "", number).otherwise(part)


def page_title(html: Cols) -> Column:
    """X11: text of the title element."""
    return collapse(F.regexp_extract(_c(html), r"(?is)<title[^>]*>(.*?)</title>", 1))


def strip_tags(html: Cols) -> Column:
    """X30."""
    return F.regexp_replace(_c(html), r"(?d)<.*?>", "")


def fingerprint(*parts: Cols) -> Column:
    """SHA-1 over parts joined by a bar; null counts as empty."""
    return F.sha1(F.concat_ws("|", *[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts]))


def chunk_id(url: Cols, title: Cols, index: Cols) -> Column:
    """X20."""
    return F.concat(F.substring(F.sha2(F.concat(_c(url), F.lit("|"), _c(title)), 256), 1, 16), F.format_string("_%04d", _c(index)))


def hk_mobile(x: Cols) -> Column:
    """eight digits that start with 5 to 9."""
    return F.replace(F.replace(_c(x), F.lit(" "), F.lit("")), F.lit("-"), F.lit("")).rlike("^[5-9][0-9]{7}$")


#: Marks of a page that the site's guard put in the place of the real one.
BLOCKED = ("attention required! | cloudflare", "sorry, you have been blocked", 'id="cf-error-details"')
#: Words of navigation lines.
NAV_WORDS = (
    "menu", "navigation", "cookie", "privacy", "terms", "subscribe", "follow", "share", "login", "signup", "register", "home", "contact",
    "關於", "聯絡", "登入", "註冊", "主頁", "首頁", "私隱", "條款", "版權", "返回", "廣告", "贊助",
)


def navigation_ratio(x: Cols) -> Column:
    """share of the lines that hold a navigation word."""
    return _once(lines(x), lambda found: _navigating(found) / F.greatest(F.lit(1), F.size(found)))


def host(url: Cols) -> Column:
    """The lower-case host of an http address, without www."""
    return F.regexp_replace(F.lower(F.regexp_extract(_c(url), r"(?i)^https?://([^/?#]*)", 1)), r"^www\.", "")


def valid_listing_url(url: Cols, site: str, path_pattern: str) -> Column:
    """F8: an address of ``site`` whose path matches; null is not valid."""
    path = F.regexp_extract(_c(url), r"(?i)^https?://[^/?#]*([^?#]*)", 1)
    return F.coalesce((host(url) == site) & path.rlike(path_pattern), F.lit(False))


def blocked_page(html: Cols) -> Column:
    """F9."""
    low = F.lower(F.coalesce(_c(html), F.lit("")))
    return low.contains(BLOCKED[0]) | low.contains(BLOCKED[1]) | low.contains(BLOCKED[2])


def price_in_text(x: Cols) -> Column:
    """The first price with a currency sign, else the first before the currency's name, else empty."""
    text = collapse(F.coalesce(_c(x), F.lit("")))
    signed = F.regexp_extract(text, r"(?i)(?:HK\$|\$)\s*([0-9][0-9,]{2,})", 1)
    return F.when(signed != "", signed).otherwise(F.regexp_extract(text, r"([0-9][0-9,]{3,})\s*港元", 1))


def bare_phone(x: Cols) -> Column:
    """A telephone link or number without the country code, dashes and spaces."""
    out = strip(F.coalesce(_c(x), F.lit("")))
    for part in ("tel:", "+852", "852-", "-", " "):
        out = F.replace(out, F.lit(part), F.lit(""))
    return out


def language_or(x: Cols, known: tuple[str, ...], default: str) -> Column:
    """A known language code, lower case, or the default."""
    code = F.lower(strip(_c(x)))
    return F.when(code.isin(*known), code).otherwise(default)


def stripped_lower(x: Cols) -> Column:
    """Stripped and in lower case; null is empty."""
    return F.lower(strip(F.coalesce(_c(x).cast("string"), F.lit(""))))


def memo_key(action: Cols, options: Cols) -> Column:
    """SHA-256 of an action and its options (a map) as JSON with sorted keys."""
    ordered = F.map_from_entries(F.array_sort(F.map_entries(_c(options))))
    return F.sha2(F.concat(_c(action), F.lit("-"), F.to_json(ordered)), 256)


def links(html: Cols) -> Column:
    """Targets of anchors in page order, each once."""
    found = F.regexp_extract_all(_c(html), F.lit(r"(?i)<a\s[^>]*?href\s*=\s*[\"']([^\"'>]+)[\"']"), F.lit(1))
    return F.array_distinct(found)
