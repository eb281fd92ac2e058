"""URL parts, link resolution and host checks, all as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.text import as_column, filled, once, strip

_SCHEME = r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?"
_HOST = r"(?://[^/?#]*)?"
_CONTROLS = "".join(map(chr, range(0x21)))


def tidy(url: Column | str) -> Column:
    """Without leading control characters and without tabs or line breaks."""
    return F.translate(F.ltrim(as_column(url), F.lit(_CONTROLS)), "\t\r\n", "")


def scheme(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(tidy(url), r"\A([a-zA-Z][a-zA-Z0-9+.-]*):", 1))


def authority(url: Column | str) -> Column:
    """`//host:port` with its slashes, or ''."""
    return F.regexp_extract(tidy(url), rf"\A{_SCHEME}(//[^/?#]*)", 1)


def host(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(authority(url), r"\A//(?:.*@)?([^@:]*)", 1))


def path(url: Column | str) -> Column:
    """Path without query, fragment or the parameters of its last segment."""
    return F.regexp_extract(tidy(url), rf"\A{_SCHEME}{_HOST}((?:[^?#]*/)?[^?#/;]*)", 1)


def unquote(value: Column | str) -> Column:
    """Percent-decode; `+` and malformed escapes stay as they are."""
    literal_plus = F.replace(as_column(value), F.lit("+"), F.lit("%2B"))
    safe = F.regexp_replace(literal_plus, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.try_url_decode(safe)


def last_segment(value: Column | str) -> Column:
    return F.substring_index(as_column(value), "/", -1)


def suffix(value: Column | str) -> Column:
    """Lower-case file extension without its dot, or NULL."""
    name = last_segment(F.regexp_replace(as_column(value), r"(?:/\.?)+\z", ""))
    return filled(F.lower(F.regexp_extract(name, r"\A(?s:.+)\.([^.]+)\z", 1)))


def slug(url: Column | str) -> Column:
    """Upper-case stem of the last path segment, or NULL."""
    stem = rf"\A{_SCHEME}{_HOST}(?:[^?#]*/)?([^?#/;]*?)(?:\.[^?#/;.]*)?(?:[?#;]|\z)"
    return filled(F.upper(strip(F.regexp_extract(tidy(url), stem, 1))))


def _fold_dots(segments: Column) -> Column:
    """Fold `.` and `..` away; a dot segment at the end leaves a directory."""
    start = F.array().cast("array<string>")
    kept = F.aggregate(
        segments,
        start,
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.array_append(acc, s)),
    )
    last = F.element_at(segments, -1)
    return F.array_join(F.concat(kept, F.when(last.isin(".", ".."), F.array(F.lit(""))).otherwise(start)), "/")


def _folded(path: Column, drop_empty: bool) -> Column:
    """Path without dot segments; only the few paths that need it are taken apart."""
    pattern = r"(?:\A|/)\.{1,2}(?:/|\z)" + ("|//" if drop_empty else "")

    def fold(p: Column) -> Column:
        def inner(s: Column) -> Column:
            if not drop_empty:
                return s
            middle = F.slice(s, 2, F.greatest(F.size(s) - 2, F.lit(0)))
            return F.concat(
                F.slice(s, 1, 1), F.filter(middle, lambda x: x != ""), F.slice(s, -1, 1)
            )

        taken_apart = once(inner(F.split(p, "/", -1)), _fold_dots)
        return F.when(p.rlike(pattern), taken_apart).otherwise(p)

    return once(path, fold)


def resolve(base: Column | str, href: Column | str) -> Column:
    """Absolute URL of a link found on the page at `base`."""
    both = F.struct(tidy(base).alias("base"), tidy(href).alias("href"))

    def parts(u: Column) -> Column:
        return F.struct(
            u["base"].alias("base"),
            u["href"].alias("href"),
            F.regexp_extract(u["base"], rf"\A({_SCHEME}{_HOST})", 1).alias("site"),
            F.regexp_extract(u["href"], rf"\A{_SCHEME}{_HOST}([^?#]*)", 1).alias("path"),
            F.regexp_extract(u["href"], r"(?s)\A[^?#]*(.*)", 1).alias("tail"),
        )

    def absolute(p: Column) -> Column:
        base, href, site, path, tail = (p[n] for n in ("base", "href", "site", "path", "tail"))
        folder = F.regexp_extract(base, rf"\A{_SCHEME}{_HOST}([^?#]*/)?", 1)
        rooted = F.when(folder == "", F.lit("/")).otherwise(folder)

        def at(folded: Column) -> Column:
            slash = F.when(folded.startswith("/"), F.lit("")).otherwise(F.lit("/"))
            return F.concat(site, slash, folded, tail)

        same_page = F.when(tail.startswith("?"), F.regexp_extract(base, r"\A([^?#]*)", 1)).otherwise(
            F.regexp_extract(base, r"\A([^#]*)", 1)
        )
        return (
            F.when(href == "", base)
            .when(href.rlike(r"\A[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme(base), F.lit(":"), href))
            .when(path == "", F.concat(same_page, tail))
            .when(path.startswith("/"), once(_folded(path, drop_empty=False), at))
            .otherwise(once(_folded(F.concat(rooted, path), drop_empty=True), at))
        )

    return F.when(
        as_column(base).isNotNull() & as_column(href).isNotNull(),
        once(both, lambda u: once(parts(u), absolute)),
    )


def host_allowed(url: Column | str, hosts: list[str]) -> Column:
    """True for the listed hosts and their subdomains."""

    def listed(h: Column) -> Column:
        allowed = F.lit(False)
        for name in hosts:
            allowed = allowed | (h == name) | h.endswith("." + name)
        return allowed

    return once(host(url), listed)


# Characters that may stand in a URL as they are; the escape of one that has no meaning of its own is undone.
_ALLOWED = r"[A-Za-z0-9\-._~:/?#\[\]@!$&'()*+,;=%]"
_UNRESERVED = r"^(?:2D|2E|5F|7E|3[0-9]|[46][1-9A-F]|[57][0-9A])$"


def normal_escapes(part: Column | str) -> Column:
    """A part of a URL with its percent escapes in one form: capital digits, none for letters, digits and `-._~`, one for
    every character that may not stand in a URL."""

    def escaped(value: Column) -> Column:
        runs = F.regexp_extract_all(value, F.lit(f"(?s){_ALLOWED}+|(?:(?!{_ALLOWED}).)+"), F.lit(0))
        written = F.transform(runs, lambda r: F.when(r.rlike(f"^{_ALLOWED}"), r).otherwise(F.replace(F.url_encode(r), F.lit("+"), F.lit("%20"))))
        return F.array_join(written, "")

    def one(piece: Column, i: Column) -> Column:
        code, rest = F.upper(F.left(piece, F.lit(2))), F.substring(piece, F.lit(3), F.length(piece))
        plain = F.when(code.rlike(_UNRESERVED), F.decode(F.unhex(code), "US-ASCII")).otherwise(F.concat(F.lit("%"), code))
        return F.when(i == 0, piece).when(code.rlike("^[0-9A-F]{2}$"), F.concat(plain, rest)).otherwise(F.concat(F.lit("%"), piece))

    def normal(value: Column) -> Column:
        return F.array_join(F.transform(F.split(escaped(value), "%"), one), "")

    value = as_column(part)
    return F.when(value.rlike(f"%|(?!{_ALLOWED})(?s:.)"), normal(value)).otherwise(value)
