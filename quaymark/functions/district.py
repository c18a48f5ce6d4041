"""District names (inventory X4, X5). Pure Column to Column."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import Cols, _c
from .text import collapse, strip

UNKNOWN = "Unknown"
#: Districts in the order in which they are looked for, by region, with the English name looked for.
DISTRICTS = {
    "香港島": (
        ("灣仔", "wan chai"), ("銅鑼灣", "causeway bay"), ("跑馬地", "happy valley"), ("西半山", "mid-levels west"), ("上環", "sheung wan"), ("中環", "central"), ("天后", "tin hau"),
        ("炮台山", "fortress hill"), ("鰂魚涌", "quarry bay"), ("筲箕灣", "shau kei wan"), ("柴灣", "chai wan"), ("西灣河", "sai wan ho"), ("西營盤", "sai ying pun"), ("大坑", "tai hang"),
        ("薄扶林", "pok fu lam"), ("堅尼地城", "kennedy town"), ("黃竹坑", "wong chuk hang"), ("香港仔", "aberdeen"), ("北角", "north point"), ("東區", "eastern district"),
    ),
    "九龍": (
        ("旺角", "mong kok"), ("油麻地", "yau ma tei"), ("尖沙咀", "tsim sha tsui"), ("佐敦", "jordan"), ("何文田", "ho man tin"), ("土瓜灣", "to kwa wan"), ("紅磡", "hung hom"),
        ("深水埗", "sham shui po"), ("觀塘", "kwun tong"), ("九龍站", "kowloon station"), ("奧運", "olympic"), ("油塘", "yau tong"), ("荔枝角", "lai chi kok"), ("大角咀", "tai kok tsui"),
        ("九龍灣", "kowloon bay"), ("油尖旺", "yau tsim mong"),
    ),
    "新界": (
        ("馬鞍山", "ma on shan"), ("沙田", "sha tin"), ("大圍", "tai wai"), ("將軍澳", "tseung kwan o"), ("坑口", "hang hau"), ("寶琳", "po lam"), ("康城", "lohas park"), ("屯門", "tuen mun"),
        ("元朗", "yuen long"), ("天水圍", "tin shui wai"), ("粉嶺", "fanling"), ("上水", "sheung shui"), ("大埔", "tai po"), ("青衣", "tsing yi"), ("荃灣", "tsuen wan"), ("東涌", "tung chung"),
        ("葵芳", "kwai fong"), ("葵青", "kwai tsing"),
    ),
}
#: Districts looked for after all others.
LAST = ("油尖旺", "葵青")
#: Labels of regions, which are no districts, and their English names.
REGION_LABELS = ("香港島", "港島", "港島區", "港島沿線", "港島南岸", "九龍", "九龍區", "新界", "新界東", "新界西", "離島", "高級豪宅區")
REGIONS_EN = ("hong kong island", "kowloon", "new territories")
#: Other spellings; every district is also its own.
ALIASES = {"湾仔": "灣仔", "灣仔區": "灣仔", "港島灣仔": "灣仔", "港島東": "東區", "東": "東區", "油尖旺區": "油尖旺", "葵青區": "葵青"}
#: Simplified and full-width signs and what replaces them.
SIGNS = ("湾区鱼东马，、｜（）", "灣區魚東馬,/|()")

_ALL = sorted(chain(*DISTRICTS.values()), key=lambda d: d[0] in LAST)
_KNOWN = {d: d for d, _ in _ALL} | ALIASES
_REGION = "(?:" + "|".join(sorted(REGION_LABELS, key=len, reverse=True)) + ")"


def _alias(x: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(v) for v in chain(*_KNOWN.items())]), x)


def _trimmed(token: Column) -> Column:
    """A token without region labels that a separator sets off at its ends."""
    token = F.regexp_replace(token, rf"^(?:{_REGION}[ ,/|\-]+)+|(?:[ ,/|\-]+{_REGION})+$", "")
    token = F.regexp_replace(token, r"(?U)^[\-\s]+|[\-\s]+$", "")
    return F.when(token.isin(*REGION_LABELS), "").otherwise(token)


def district_name(x: Cols) -> Column:
    """The district of a free-form place; null, empty and mere regions are Unknown.

    In order: a district's name anywhere in the text, an alias, an alias after a region's name, then
    the comma-separated tokens (an alias among them, else the first).  Several region labels in a row
    at one end of a token all go.
    """
    text = F.translate(collapse(F.coalesce(_c(x).cast("string"), F.lit(""))), *SIGNS)
    text = strip(F.regexp_replace(strip(F.regexp_replace(text, "【[^】]*】", "")), r"\([^)]*\)", ""))
    lowered, found = F.lower(text), F.when(text.isin(*REGION_LABELS) | F.lower(text).isin(*REGIONS_EN) | (text == ""), UNKNOWN)
    for name, english in _ALL:
        found = found.when(text.contains(name) | lowered.rlike(rf"(?U)\b{english}\b"), name)
    bare = _alias(F.regexp_replace(F.regexp_replace(text, f"^{_REGION}", ""), r"^[ ,/|\-]+|[ ,/|\-]+$", ""))
    return found.otherwise(F.coalesce(_alias(text), F.when(text.rlike(f"^{_REGION}"), bare), _from_tokens(text)))


def _from_tokens(text: Column) -> Column:
    split = F.filter(F.transform(F.split(text, "[,/|]"), strip), lambda t: t != "")
    split = F.when(F.size(split) > 0, split).otherwise(F.filter(F.split(text, " "), lambda t: t != ""))
    tokens = F.filter(F.transform(F.filter(split, lambda t: ~t.isin(*REGION_LABELS)), _trimmed), lambda t: t != "")
    first, second = F.try_element_at(tokens, F.lit(1)), F.try_element_at(tokens, F.lit(2))

    def known(token: Column) -> Column:
        token = F.replace(token, F.lit(" "), F.lit(""))
        return F.coalesce(F.when(token.endswith("區") & (F.length(token) > 2), _alias(F.regexp_replace(token, "區$", ""))), _alias(token))

    aliases = F.filter(F.transform(tokens, known), lambda t: t.isNotNull())
    return (
        F.when(F.size(tokens) == 0, UNKNOWN)
        .when(first.endswith("區") & second.isNotNull(), F.coalesce(_alias(second), second))
        .when(F.size(aliases) > 0, F.try_element_at(aliases, F.lit(1)))
        .when(first.rlike(r"^[\x{4e00}-\x{9fff}]$"), UNKNOWN)
        .otherwise(first)
    )


def region_of(district: Cols) -> Column:
    """The region of a district; one of the new towns counts with the islands."""
    d = _c(district)
    out = F.when(d == "東涌", "離島")
    for region, names in DISTRICTS.items():
        out = out.when(d.isin(*[n for n, _ in names]), region)
    return out.otherwise(UNKNOWN)


#: English names that are not their words with a capital letter each, and simplified signs of names.
ENGLISH = {"西半山": "Mid-Levels West", "康城": "LOHAS Park"}
SIMPLIFIED = ("灣銅鑼馬環鰂魚營盤堅黃東區龍奧運觀圍將軍寶門嶺紅", "湾铜锣马环鲗鱼营盘坚黄东区龙奥运观围将军宝门岭红")


def english_name(district: Cols) -> Column:
    """The English name of a known district; any other as it is."""
    d = _c(district)
    names = {zh: ENGLISH.get(zh, en.title()) for zh, en in _ALL}
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for v in chain(*names.items())]), d), d)


def simplified_name(district: Cols) -> Column:
    """The name of a known district in simplified signs; any other as it is."""
    d = _c(district)
    return F.when(d == UNKNOWN, "未知").when(d.isin(*[zh for zh, _ in _ALL]), F.translate(d, *SIMPLIFIED)).otherwise(d)
