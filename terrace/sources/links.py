"""Links of crawled index pages as a DataFrame ``(page_id, url, pos, href)``."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Anchors(HTMLParser):
    """Collects the first non-empty ``href`` of every ``<a>`` start tag.

    The standard parser skips comments, script and style text, reads quoted ``>``
    as part of the value and decodes every character reference.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hrefs: list[str] = []

    def handle_starttag(self, tag, attrs):
        href = next((v for k, v in attrs if k == "href"), None) if tag == "a" else None
        if href:
            self.hrefs.append(href)


def href_values(html: str | None) -> list[str]:
    parser = _Anchors()
    parser.feed(html or "")
    parser.close()
    return parser.hrefs


def extract_links(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per non-empty href: ``(page_id, url, pos, href)``; ``pos`` counts kept links.

    HTML is not a regular language, so pages go through the standard library's
    parser in Arrow batches; each page is one row and nothing is shuffled.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [href_values(h) for h in batch.column(2).to_pylist()]
            owner = pa.array([i for i, hrefs in enumerate(found) for _ in hrefs], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(owner),
                    batch.column(1).take(owner),
                    pa.array([k for hrefs in found for k in range(len(hrefs))], pa.int64()),
                    pa.array([h for hrefs in found for h in hrefs], pa.string()),
                ],
                names=["page_id", "url", "pos", "href"],
            )

    return rows.mapInArrow(run, f"page_id {kind}, url string, pos bigint, href string")
