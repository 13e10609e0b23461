"""Main text of HTML pages: leaf blocks, a recurrent labeller, and the article's blocks in order.

The labeller is trained once in the driver's process (seconds, a fixed number of written
pages) and goes to the tasks with the function; pages are then labelled batch by batch.

Defined results: a null or empty page, or one without article blocks, has an empty text;
repeated rows give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .block_labeller import Labeller, trained
from .common import map_frames, ship
from .html_blocks import blocks

#: Rows labelled together in a task; bounds its memory whatever the batches of the session hold.
ROWS = 512


def main_texts(htmls: list[str], labeller: Labeller) -> list[str]:
    pages = [blocks(h) for h in htmls]
    return ["\n".join(b.text for b, yes in zip(page, labels) if yes)
            for page, labels in zip(pages, labeller.label(pages))]


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (and the number of blocks kept) of every page."""
    ship(pages.sparkSession)
    labeller = trained()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.iloc[at:at + ROWS]
                texts = main_texts(list(part["html"]), labeller)
                yield pd.DataFrame({"page_id": part["page_id"].astype("Int64").array, "url": part["url"].to_numpy(),
                                    "text": texts, "n_chars": [len(x) for x in texts]})

    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return map_frames(rows, run, "page_id long, url string, text string, n_chars long")
