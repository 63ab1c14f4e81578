"""Generation jobs: what is left to render, with which seed and in which batch; the renderer itself is injected."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions.text import col
from quarrymill.functions.vocab import NEGATIVE_PROMPT
from quarrymill.operators.sampling import batch, numbered, stride

RESULT = "prompt_id string, status string, error string, content binary, batch_size int, batch_runtime_s double, runtime_s double"
#: Results leave a task in frames of so many rows, or once they hold so many bytes of contents.
FRAME_ROWS, FRAME_BYTES = 1000, 4 << 20


@dataclass(frozen=True)
class RenderOptions:
    height: int = 480
    width: int = 832
    num_frames: int = 81
    fps: int = 16
    quality: int = 5
    output_ext: str = "mp4"
    batch_size: int = 1
    num_inference_steps: int = 50
    cfg_scale: float = 6.0
    sigma_shift: float = 8.0
    seed_offset: int = 0
    tiled: bool = True
    max_items: int | None = None
    max_attempts: int = 3
    negative_prompt: str = NEGATIVE_PROMPT


GEOMETRY = ("height", "width", "num_frames", "fps", "cfg_scale", "num_inference_steps", "sigma_shift")


def plan(records: DataFrame, done: DataFrame, options: RenderOptions = RenderOptions(), world: int = 1) -> DataFrame:
    """The records to render: those without a finished artifact, numbered by id, with rank (a stride over `world`) and
    batch within the rank, the seed, the path, and the geometry. Records need prompt_id; seed_hint and negative_prompt
    may be null. `max_items` takes the first by id."""
    if options.max_items is not None:
        records = records.orderBy("prompt_id").limit(options.max_items)
    left = records.join(done.select("prompt_id").distinct(), "prompt_id", "left_anti")
    placed = numbered(left, ["prompt_id"])
    rank = stride("n", world)
    out = placed.withColumns({
        "rank": rank, "batch": batch(F.floor(F.col("n") / world), options.batch_size),
        "seed": F.coalesce(F.col("seed_hint"), F.lit(0)).cast("long") + options.seed_offset,
        "negative_prompt": F.coalesce(F.nullif("negative_prompt", F.lit("")), F.lit(options.negative_prompt)),
        "video_path": F.concat(F.lit("videos/"), F.col("prompt_id"), F.lit(f".{options.output_ext}")),
    })
    return out.withColumns({k: F.lit(v) for k, v in asdict(options).items() if k in GEOMETRY}).drop("n")


def dry_run(items: list[dict]) -> list[bytes]:
    """Placeholder contents, for tests of everything around the model."""
    return [f"dry run {item['prompt_id']} {item['seed']}".encode() for item in items]


def render(planned: DataFrame, renderer: Callable[[list[dict]], list[bytes]] = dry_run, options: RenderOptions = RenderOptions()) -> DataFrame:
    """One row per planned record: status `ok` with its content, or `failed` with the error.

    A task hands its records to the renderer in batches and sets it up once, as functions keep their state in a worker.
    A batch that fails, or returns another number of contents, is tried again item by item, so each item has a status
    of its own, and no item is tried more than `max_attempts` times. A batch's time is shared among its items.
    """

    def attempt(items: list[dict]) -> list[bytes]:
        contents = renderer(items)
        if len(contents) != len(items):
            raise ValueError(f"{len(contents)} results for {len(items)} items")
        return contents

    def one(items: list[dict]) -> list[tuple]:
        began = time.perf_counter()
        try:
            contents = attempt(items)
        except Exception as error:  # noqa: BLE001  the renderer is foreign code
            if len(items) > 1:
                return [row for item in items for row in one([item])]
            for _ in range(options.max_attempts - 1):
                try:
                    contents = attempt(items)
                    break
                except Exception as again:  # noqa: BLE001
                    error = again
            else:
                return [(items[0]["prompt_id"], "failed", repr(error), None, 1, time.perf_counter() - began, time.perf_counter() - began)]
        took = time.perf_counter() - began
        return [(item["prompt_id"], "ok", None, content, len(items), took, took / len(items)) for item, content in zip(items, contents, strict=True)]

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[list[dict]]:
        """The items of each batch; one that a frame cuts goes on in the next."""
        items = (item for frame in frames for item in frame.to_dict("records"))
        return (list(group) for _, group in groupby(items, key=itemgetter("rank", "batch")))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in RESULT.split(", ")]
        rows, held = [], 0
        for items in batches(frames):
            done = one(items)
            rows += done
            held += sum(len(row[3] or b"") for row in done)
            if len(rows) >= FRAME_ROWS or held >= FRAME_BYTES:
                yield pd.DataFrame(rows, columns=names)
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)

    dealt = planned.repartition("rank", "batch").sortWithinPartitions("rank", "batch", "prompt_id")
    return dealt.mapInPandas(run, RESULT)


def item_runtime(batch_runtime: Column | str, items: Column | str) -> Column:
    """A batch's time shared among its items; null without items."""
    return F.when(col(items) > 0, col(batch_runtime) / col(items))


def sidecars(planned: DataFrame, results: DataFrame) -> DataFrame:
    """The finished records with their run times, without the contents."""
    finished = results.where("status = 'ok'").select("prompt_id", "batch_size", "batch_runtime_s", "runtime_s")
    return planned.join(finished, "prompt_id")
