"""Column expressions for markup and links: character references, link resolution,
and a fold over long arrays.

All of it is built from Spark functions, evaluated inside the row.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements folded before their results are put away.
BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def fold_out(items: Column, state: Column, out_type: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """A fold over ``items`` that also yields elements: struct(s: last state, out: what was yielded).

    ``step(state, item)`` gives the next state (the same struct type) and an element, or
    NULL for none.  Spark's fold copies what it carries at every step; here the yielded
    elements of one block are carried, and a block's are put away when it ends, so the
    time grows with the length and not with its square."""
    none = F.array().cast(f"array<{out_type}>")

    def one(acc: Column, item: Column) -> Column:
        after, made = step(acc["s"], item)
        return F.struct(after.alias("s"), let(made, lambda m: F.when(m.isNull(), acc["out"])
                                              .otherwise(F.concat(acc["out"], F.array(m)))).alias("out"))

    def block(acc: Column, at: Column) -> Column:
        part = F.aggregate(F.slice(items, at, F.lit(BLOCK)), F.struct(acc["s"].alias("s"), none.alias("out")), one)
        return let(part, lambda p: F.struct(p["s"].alias("s"), F.concat(acc["out"], F.array(p["out"])).alias("out")))

    starts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(BLOCK))) \
        .otherwise(F.array().cast("array<int>"))
    begin = F.struct(state.alias("s"), F.array().cast(f"array<array<{out_type}>>").alias("out"))
    return F.aggregate(starts, begin, block, lambda acc: F.struct(acc["s"].alias("s"), F.flatten(acc["out"]).alias("out")))


# ---------------------------------------------------------------------------
# character references
# ---------------------------------------------------------------------------
#: Names that count without a semicolon, the longest first.
_NAMES = {n: c for n, c in html5.items() if n.endswith(";")}
_OPEN_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
# Code points 128-159 stand for the characters of Windows-1252.
_WINDOWS = {i: bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 160)}
_REPLACED = {0: "�", 13: "\r", **_WINDOWS}


def _map_literal(entries: dict) -> Column:
    """A map as one literal (folded from JSON when the query is planned)."""
    return F.from_json(F.lit(json.dumps({str(k): v for k, v in entries.items()})), "map<string,string>")


def _character(code: Column) -> Column:
    """The character of a code point; U+FFFD where there is none."""
    bad = code.isNull() | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    silent = (code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF)
              | (F.pmod(code, F.lit(65536)) >= 0xFFFE))
    utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
    known = F.try_element_at(_map_literal(_REPLACED), code.cast("string"))
    return F.coalesce(known, F.when(bad, F.lit("�")).when(silent, F.lit("")).otherwise(F.decode(utf32, "UTF-32")))


def _reference(piece: Column, attribute: Column) -> Column:
    """What stands after an ampersand, with its reference (if it begins with one) replaced."""
    def rest(mark: Column) -> Column:
        return F.substring(piece, F.char_length(mark) + 1, F.char_length(piece))

    def number(mark: Column) -> Column:
        is_hex = F.lower(F.substring(mark, 2, 1)) == "x"
        digits = F.regexp_extract(mark, r"^#[xX]?0*([0-9A-Fa-f]*)", 1)
        padded = F.concat(F.lit("0"), digits)
        code = F.when(F.char_length(digits) <= 9, F.when(is_hex, F.conv(padded, 16, 10)).otherwise(padded).cast("bigint"))
        return F.concat(let(code, _character), rest(mark))

    def name(mark: Column) -> Column:
        """``mark``: struct(full: a name up to its semicolon, open: one that needs none)."""
        # every open name also exists with its semicolon
        found = F.transform(F.array(mark["full"], F.concat(mark["open"], F.lit(";"))),
                            lambda k: F.try_element_at(_map_literal(_NAMES), k))
        # in an attribute a name without its semicolon must not run on
        stands = ~(attribute & rest(mark["open"]).rlike("^[=A-Za-z0-9]"))
        return let(found, lambda f: F.when(f[0].isNotNull(), F.concat(f[0], rest(mark["full"])))
                   .when(f[1].isNotNull() & stands, F.concat(f[1], rest(mark["open"])))
                   .otherwise(F.concat(F.lit("&"), piece)))

    return F.when(piece.rlike("^#([0-9]|[xX][0-9A-Fa-f])"),
                  let(F.regexp_extract(piece, "^(#(?:[0-9]+|[xX][0-9A-Fa-f]+);?)", 1), number)) \
        .when(piece.rlike("^[A-Za-z]"), let(F.struct(
            F.regexp_extract(piece, "^([A-Za-z][A-Za-z0-9]*;)", 1).alias("full"),
            F.regexp_extract(piece, "^(" + "|".join(_OPEN_NAMES) + ")", 1).alias("open")), name)) \
        .otherwise(F.concat(F.lit("&"), piece))


def decoded(text: Column, attribute: Column | bool = False) -> Column:
    """``text`` with its character references replaced, each once."""
    flag = F.lit(attribute) if isinstance(attribute, bool) else attribute

    def of(pieces: Column) -> Column:
        later = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), lambda p: _reference(p, flag))
        return F.concat(pieces[0], F.array_join(later, ""))
    return F.when(~text.contains("&"), text).otherwise(let(F.split(text, "&"), of))


# ---------------------------------------------------------------------------
# links
# ---------------------------------------------------------------------------
# Schemes whose links may be relative.
_RELATIVE = ("", "ftp", "http", "https", "file", "sftp", "ws", "wss")
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def link_parts(link: Column) -> Column:
    """Scheme (lower case), host, path, query and fragment of a link; absent ones are empty."""
    def of(clean: Column) -> Column:
        found = [F.regexp_extract(clean, f"(?s){_PARTS}", i) for i in range(1, 6)]
        return F.struct(F.lower(found[0]).alias("scheme"),
                        *[f.alias(n) for f, n in zip(found[1:], ("host", "path", "query", "fragment"))])
    return let(F.regexp_replace(link, "[\\t\\r\\n]", ""), of)


def _joined(scheme: Column, host: Column, path: Column, query: Column, fragment: Column) -> Column:
    rooted = F.when((host != "") & (path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
                    F.when(host != "", F.concat(F.lit("//"), host)).otherwise(F.lit("")), rooted,
                    F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
                    F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit("")))


def _without_dots(path: Column) -> Column:
    """Segments ``.`` and ``..`` taken away; a last one names a folder; nothing left is the root."""
    def of(segments: Column) -> Column:
        kept = F.aggregate(segments, F.array().cast("array<string>"), lambda acc, x: F.when(
            x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc)
            .otherwise(F.concat(acc, F.array(x))))
        whole = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
        return let(F.array_join(whole, "/"), lambda p: F.when(p == "", F.lit("/")).otherwise(p))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), let(F.split(path, "/"), of)).otherwise(
        F.when(path == "", F.lit("/")).otherwise(path))


def resolve(base_link: Column, base: Column, href: Column) -> Column:
    """``href`` as seen from a page: ``base_link``, whose ``link_parts`` are ``base``.

    A link with a scheme of its own, or a page whose scheme knows no relative links, stays
    as it is; an empty one is the page itself; one of a query or fragment alone keeps the
    page's path; a path is taken from the page's folder; empty inner segments of a relative
    path go."""
    def of(r: Column) -> Column:
        folder = F.regexp_extract(base["path"], "^(.*/)", 1)
        relative = F.regexp_replace(F.concat(folder, r["path"]), "(?<=.)/{2,}", "/")
        path = F.when(r["path"].startswith("/"), r["path"]).otherwise(relative)
        foreign = ((r["scheme"] != "") & (r["scheme"] != base["scheme"])) | ~base["scheme"].isin(*_RELATIVE)
        here, elsewhere = r["path"] == "", r["host"] != ""
        parts = F.struct(
            F.when(elsewhere, r["host"]).otherwise(base["host"]).alias("host"),
            F.when(elsewhere, r["path"]).when(here, base["path"]).otherwise(let(path, _without_dots)).alias("path"),
            F.when(here & ~elsewhere & (r["query"] == ""), base["query"]).otherwise(r["query"]).alias("query"))
        return F.when(href == "", base_link).when(foreign, href).otherwise(let(parts, lambda p: _joined(
            base["scheme"], p["host"], p["path"], p["query"], r["fragment"])))
    return let(link_parts(href), of)


def file_name(link: Column) -> Column:
    """Last segment of a link with its query string, percent-decoded; ``+`` and a percent sign
    without two digits stay."""
    safe = F.replace(F.regexp_replace(link, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    return F.regexp_extract(F.coalesce(F.try_url_decode(safe), link), r"([^/]*)$", 1)
