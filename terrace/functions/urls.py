"""URL resolution as column expressions (RFC 3986, with the lenient readings that crawlers expect).

A reference is cut into scheme, authority, path, parameters, query and fragment by regular
expressions; a relative path is laid on the base's directory, and dot segments are removed
by a fold over the path's segments. No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Schemes whose references may be relative, and those whose last path segment may carry ";parameters".
RELATIVE = "ftp http gopher nntp imap wais file https shttp mms prospero rtsp rtsps rtspu sftp svn svn+ssh ws wss".split()
PARAMETERS = "ftp hdl prospero http imap https shttp rtsp rtsps rtspu sip sips mms sftp tel".split()


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def split_url(url: Column, scheme: Column) -> Column:
    """A reference's parts as a struct; a part that is not there is empty, ``scheme`` stands in for a missing one.

    White space and control characters in front, and tabs and line breaks anywhere, are dropped.
    """

    def cut(clean: Column) -> Column:
        own = F.lower(F.regexp_extract(clean, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
        rest = F.regexp_replace(clean, r"^[A-Za-z][A-Za-z0-9+.\-]*:", "")
        return F.struct(F.when(own == "", scheme).otherwise(own).alias("scheme"), rest.alias("rest"))

    def finish(s: Column) -> Column:
        place = F.regexp_extract(s["rest"], r"(?s)^(?://[^/?#]*)?([^?#]*)", 1)
        last = F.regexp_extract(place, r"(?s)^(?:.*/)?[^/;]*;([^/]*)\z", 1)
        with_parameters = s["scheme"].isin("", *PARAMETERS) & place.rlike(r"(?s)^(?:.*/)?[^/;]*;[^/]*\z")
        return F.struct(
            s["scheme"].alias("scheme"),
            F.regexp_extract(s["rest"], r"^//([^/?#]*)", 1).alias("authority"),
            F.when(with_parameters, F.regexp_replace(place, r"(?s);[^/]*\z", "")).otherwise(place).alias("path"),
            F.when(with_parameters, last).otherwise(F.lit("")).alias("parameters"),
            F.regexp_extract(s["rest"], r"(?s)^[^?#]*\?([^#]*)", 1).alias("query"),
            F.regexp_extract(s["rest"], r"(?s)^[^#]*#(.*)\z", 1).alias("fragment"),
        )

    clean = F.translate(F.regexp_replace(url, r"^[\x00-\x20]+", ""), "\t\r\n", "")
    return bind(bind(clean, cut), finish)


def join_url(scheme: Column, authority: Column, path: Column, parameters: Column, query: Column, fragment: Column) -> Column:
    """The text of a reference's parts; empty parts leave no mark."""

    def behind(mark: str, part: Column) -> Column:
        return F.when(part != "", F.concat(F.lit(mark), part)).otherwise(F.lit(""))

    def text(place: Column) -> Column:
        rooted = (place == "") | place.startswith("/")
        with_host = (
            F.when(authority != "", F.concat(F.lit("//"), authority, F.when(rooted, F.lit("")).otherwise(F.lit("/")), place))
            .when(place.startswith("//") | ((scheme != "") & rooted), F.concat(F.lit("//"), place))
            .otherwise(place)
        )
        before = F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit(""))
        return F.concat(before, with_host, behind("?", query), behind("#", fragment))

    return bind(F.concat(path, behind(";", parameters)), text)


def without_dots(segments: Column) -> Column:
    """Path of ``segments`` after ``.`` and ``..`` have done their work; never empty."""

    def step(done: Column, s: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(s == "..", up).when(s == ".", done).otherwise(F.concat(done, F.array(s)))

    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    path = F.array_join(F.when(ends_in_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    return F.when(path == "", F.lit("/")).otherwise(path)


def laid_on(base: Column, path: Column) -> Column:
    """Segments of ``path`` in the directory of ``base``; empty segments inside are dropped, as of no meaning there."""
    parts = F.split(base, "/")
    folder = F.when(F.element_at(parts, -1) == "", parts).otherwise(F.slice(parts, F.lit(1), F.size(parts) - 1))

    def tidy(all_of: Column) -> Column:
        n = F.size(all_of)
        inner = F.filter(F.slice(all_of, F.lit(2), F.greatest(n - 2, F.lit(0))), lambda s: s != "")
        whole = F.concat(F.slice(all_of, F.lit(1), F.lit(1)), inner, F.slice(all_of, n, F.lit(1)))
        return F.when(n < 2, all_of).otherwise(whole)

    return F.when(path.startswith("/"), F.split(path, "/")).otherwise(bind(F.concat(folder, F.split(path, "/")), tidy))


def resolve(base: Column, href: Column) -> Column:
    """``href`` as found on the page at ``base`` (null if either is null).

    A reference of another scheme, or of one that has no relative form, stays as it is; an
    empty one is the base.
    """

    def with_base(b: Column) -> Column:
        return bind(split_url(href, b["scheme"]), lambda h: joined(b, h))

    def joined(b: Column, h: Column) -> Column:
        query = F.when(h["query"] == "", b["query"]).otherwise(h["query"])
        same_place = (h["path"] == "") & (h["parameters"] == "")
        return (
            F.when((h["scheme"] != b["scheme"]) | ~h["scheme"].isin("", *RELATIVE), href)
            .when(h["authority"] != "", join_url(h["scheme"], h["authority"], h["path"], h["parameters"], h["query"], h["fragment"]))
            .when(same_place, join_url(h["scheme"], b["authority"], b["path"], b["parameters"], query, h["fragment"]))
            .otherwise(join_url(h["scheme"], b["authority"], without_dots(laid_on(b["path"], h["path"])), h["parameters"], h["query"], h["fragment"]))
        )

    missing = base.isNull() | href.isNull()
    whole = bind(split_url(base, F.lit("")), with_base)
    return F.when(missing, F.lit(None).cast("string")).when(base == "", href).when(href == "", base).otherwise(whole)
