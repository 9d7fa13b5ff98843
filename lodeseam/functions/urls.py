"""URL columns, all native: normal form, resolution, domains, files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V

CONTROL = r"[\x00-\x1F]"
SPLIT = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
PATH_SAFE = r"/%:@!$&'()*+,;=\-._~A-Za-z0-9"
QUERY_SAFE = PATH_SAFE + r"?\[\]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body of a value that is worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, SPLIT, k)


def _parts(url: Column) -> Column:
    """struct<scheme, net, path, query, whole>: the scheme in lower case."""
    return F.struct(F.lower(_part(url, 1)).alias("scheme"), _part(url, 2).alias("net"), _part(url, 3).alias("path"), _part(url, 4).alias("query"), url.alias("whole"))


def _stripped(url: Column) -> Column:
    return F.regexp_replace(url, r"(?U)^\s+|\s+$", "")


def _encoded(text: Column, safe: str) -> Column:
    """Characters that aren't safe as percent-encoded UTF-8."""
    one = lambda c: F.when(F.rlike(c, F.lit(f"^[{safe}]?$")), c).otherwise(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")))
    return let(text, lambda t: F.when(F.rlike(t, F.lit(f"[^{safe}]")), F.array_join(F.transform(F.split(t, ""), one), "")).otherwise(t))


def _pushed(done: Column, segment: Column) -> Column:
    """The segments so far and the next one; .. takes the last away."""
    return F.when(segment != "..", F.concat(done, F.array(segment))).otherwise(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))


def _without_dots(path: Column) -> Column:
    """The path with . and .. and empty segments resolved; exactly two leading slashes stay two."""

    def clean(p: Column) -> Column:
        lead = F.when(F.rlike(p, F.lit("^//(?!/)")), "//").otherwise("/")
        kept = F.aggregate(F.filter(F.split(p, "/"), lambda x: (x != "") & (x != ".")), F.array().cast("array<string>"), _pushed)
        return F.when(p == "", "/").otherwise(F.concat(lead, F.array_join(kept, "/")))

    return let(path, clean)


def _joined(path: Column) -> Column:
    """A rooted path with . and .. taken out and empty segments left, as a reference is resolved."""
    kept = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), lambda done, p: F.when(p == ".", done).otherwise(_pushed(done, p)))
    return let(F.array_join(kept, "/"), lambda out: F.when(F.startswith(out, F.lit("/")), out).otherwise(F.concat(F.lit("/"), out)))


def normalize(url: Column) -> Column:
    """The normal form of an HTTP(S) URL without its fragment; empty for what isn't one."""

    def site_and_path(p: Column) -> Column:
        v6 = F.rlike(p["net"], F.lit(r"^\[[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*\](?::[0-9]*)?$"))
        host = F.lower(F.when(v6, F.regexp_extract(p["net"], r"^(\[[^\]]*\])", 1)).otherwise(F.regexp_extract(p["net"], "^([^:]*)", 1)))
        return F.struct(p.alias("p"), v6.alias("v6"), host.alias("host"), F.regexp_extract(p["net"], r":([^:\]]*)$", 1).alias("port"), _without_dots(F.when(p["path"] == "", "/").otherwise(p["path"])).alias("clean"))

    def built(x: Column) -> Column:
        p, port = x["p"], x["port"].try_cast("int")
        fine = (
            p["scheme"].isin("http", "https")
            & (x["host"] != "")
            & ~F.rlike(p["net"], F.lit(r"(?U)[@\s]"))
            & (x["v6"] | ~F.rlike(p["net"], F.lit(r"[\[\]]|:.*:")))
            & F.rlike(x["port"], F.lit("^[0-9]*$"))
            & ((x["port"] == "") | (port <= 65535))
        )
        default = (x["port"] == "") | (port == 0) | ((p["scheme"] == "http") & (port == 80)) | ((p["scheme"] == "https") & (port == 443))
        site = F.when(default, x["host"]).otherwise(F.concat_ws(":", x["host"], port))
        clean = F.when(F.endswith(p["path"], F.lit("/")) & (x["clean"] != "/"), F.concat(x["clean"], F.lit("/"))).otherwise(x["clean"])
        tail = F.when(p["query"] == "", "").otherwise(F.concat(F.lit("?"), _encoded(p["query"], QUERY_SAFE)))
        return F.when(fine, F.concat(p["scheme"], F.lit("://"), site, _encoded(clean, PATH_SAFE), tail))

    whole = let(url, lambda u: F.when(~F.rlike(u, F.lit(CONTROL)), let(let(_parts(_stripped(u)), site_and_path), built)))
    return F.coalesce(whole, F.lit(""))


def resolve(base: Column, href: Column) -> Column:
    """The normal form of a link's target as seen from its page; empty for what can't be crawled."""

    def rooted(b: Column, h: Column) -> Column:
        folder = F.regexp_extract(b["path"], "^(.*/)", 1)
        joined = F.when(F.startswith(h["path"], F.lit("/")), h["path"]).otherwise(F.regexp_replace(F.concat(F.when(folder == "", "/").otherwise(folder), h["path"]), "/+", "/"))
        ended = let(joined, lambda j: F.when(F.rlike(j, F.lit(r"(^|/)\.\.?$")), F.concat(j, F.lit("/"))).otherwise(j))
        return F.when(h["path"] == "", b["path"]).otherwise(_joined(ended))

    def target(x: Column) -> Column:
        b, h = x["b"], x["h"]
        own_net = F.rlike(h["whole"], F.lit(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//"))
        asked = F.when((h["path"] == "") & (h["query"] == ""), b["query"]).otherwise(h["query"])
        relative = F.concat(b["scheme"], F.lit("://"), b["net"], rooted(b, h), F.when(asked == "", "").otherwise(F.concat(F.lit("?"), asked)))
        return (
            F.when(~b["scheme"].isin("http", "https") | (b["net"] == ""), h["whole"])
            .when((h["scheme"] != "") & (h["scheme"] != b["scheme"]), h["whole"])
            .when(own_net, F.when(h["scheme"] == "", F.concat(b["scheme"], F.lit(":"), h["whole"])).otherwise(h["whole"]))
            .otherwise(relative)
        )

    found = let(F.struct(_parts(_stripped(base)).alias("b"), _parts(href).alias("h")), target)
    return F.when(F.rlike(href, F.lit(CONTROL)) | href.isNull(), "").otherwise(normalize(found))


def host(url: Column) -> Column:
    """The host of a URL in normal form, without trailing dots."""
    return F.regexp_replace(F.regexp_extract(url, r"^https?://(\[[^\]]*\]|[^/:?#]*)", 1), r"\.+$", "")


def origin(url: Column) -> Column:
    return F.regexp_extract(url, "^(https?://[^/?#]+)", 1)


def path(url: Column) -> Column:
    return _part(url, 3)


def within(url: Column, base: Column) -> Column:
    """Whether a URL in normal form is on the base's host or a subdomain of it."""
    u, b = host(url), host(base)
    return (u != "") & (b != "") & ((u == b) | F.endswith(u, F.concat(F.lit("."), b)))


def _ends_with(url: Column, endings: list[str]) -> Column:
    return F.rlike(F.lower(path(url)), F.lit(rf"\.(?:{'|'.join(endings)})$"))


def is_document(url: Column) -> Column:
    return _ends_with(url, V.DOCUMENT_EXTENSIONS)


def is_file(url: Column) -> Column:
    """Whether the path ends like a document, picture, archive, film or sound."""
    return _ends_with(url, V.FILE_EXTENSIONS)


def should_crawl(url: Column) -> Column:
    """Whether a URL in normal form is a page to fetch."""
    return (url != "") & ~is_file(url)


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(path(url), "/"), -1)
