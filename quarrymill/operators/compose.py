"""Prompts composed from a taxonomy: every choice is a hash of seed, id and slot, so rows are independent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions.text import hash_pick

#: Our own vocabulary; each group has its own subjects, actions, scenes and details.
TAXONOMY = {
    "styles": ["film-like clip", "plain field recording", "hand-drawn animation", "slow nature study"],
    "camera_setups": ["a handheld close-up", "a wide fixed view", "a slow pan to the left", "a dolly move towards the subject", "an even tracking shot"],
    "lighting": ["pale dawn light", "hard noon sun", "the glow of lamps", "grey light before rain"],
    "moods": ["unhurried", "tense but hopeful", "cheerful", "solemn"],
    "quality_tags": ["steady framing", "true colors", "clear motion", "the same identity throughout", "fine texture"],
    "subject_groups": [
        {"name": "river_life", "subject_type": "animal", "subjects": ["a brown bear", "two ducklings and a duck", "a silver fish"], "actions": ["drifts", "is swimming again", "turns behind reeds"], "scenes": ["along a river in a forest", "under a waterfall", "near a meadow"], "details": ["Drops of water hang in the air", "Mist lies on the surface", "Leaves fall slowly"]},
        {"name": "town_work", "subject_type": "human", "subjects": ["a worker", "three children", "an old woman"], "actions": ["is walking fast", "paints with one hand", "stands still"], "scenes": ["on a market street", "inside a small workshop", "at a station"], "details": ["Smoke rises far away", "A book lies open", "People pass by"]},
        {"name": "machines", "subject_type": "vehicle", "subjects": ["a red truck", "a rocket", "a small boat"], "actions": ["is driving on", "rolls to a stop", "waits"], "scenes": ["in open space", "before a mountain", "beside the ocean"], "details": ["Waves break in the storm", "Nothing else moves", "A robot looks on"]},
    ],
}
SLOTS = ("styles", "camera_setups", "lighting", "moods")
PARTS = ("subjects", "actions", "scenes", "details")


def texts(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def compose(df: DataFrame, key: str, seed: int, taxonomy: dict = TAXONOMY) -> DataFrame:
    """df with subject_group, subject_type, style, camera, lighting, mood, subject, action, scene, detail, quality (three
    different ones, in hash order) and prompt."""
    groups = taxonomy["subject_groups"]
    pick = lambda slot, values: F.element_at(texts(values), (hash_pick(seed, key, slot, len(values)) + 1).cast("int"))
    group = hash_pick(seed, key, "group", len(groups)).cast("int") + 1
    own = lambda part: F.element_at(F.array(*(pick(part, g[part]) for g in groups)), group)
    named = dict(zip(("style", "camera", "lighting", "mood"), (pick(s, taxonomy[s]) for s in SLOTS), strict=True))
    named |= dict(zip(("subject", "action", "scene", "detail"), (own(p) for p in PARTS), strict=True))
    tagged = F.array_sort(F.transform(texts(taxonomy["quality_tags"]), lambda q: F.struct(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"), F.lit(":quality:"), q)).alias("h"), q.alias("q"))))
    named |= {"subject_group": F.element_at(texts([g["name"] for g in groups]), group), "subject_type": F.element_at(texts([g["subject_type"] for g in groups]), group), "quality": F.slice(tagged, 1, 3)["q"]}
    out = df.withColumns(named)
    q = lambda i: F.element_at("quality", i)
    parts = [F.col("style"), ": ", F.col("subject"), " ", F.col("action"), " ", F.col("scene"), ". ", F.col("detail"), ". Seen in ", F.col("camera"), ", lit by ", F.col("lighting"), "; the mood is ", F.col("mood"), ". Wanted: ", q(1), ", ", q(2), ", ", q(3), "."]
    sentence = F.concat(*(F.lit(part) if isinstance(part, str) else part for part in parts))
    return out.withColumn("prompt", sentence)


def compose_bank(spark, count: int, split: str, seed: int, prefix: str = "bank", taxonomy: dict = TAXONOMY, spread: int = 8) -> DataFrame:
    """`count` different composed prompts with ids; `spread` times as many are made to choose from. Raises if short."""
    from quarrymill.functions.text import hash_order, row_id
    from quarrymill.operators.sampling import keep_first

    made = compose(spark.range(count * spread), "id", seed, taxonomy)
    unique = keep_first(made, "prompt", "id").orderBy("id").limit(count)
    from pyspark.sql import Window

    out = unique.withColumn("index", F.row_number().over(Window.orderBy("id")) - 1)
    if out.count() < count:
        raise ValueError(f"not enough different prompts for {split}")
    # source and license are fixed values
    return out.withColumns({"prompt_id": row_id(prefix, split, "index"), "split": F.lit(split), "lang": F.lit("en"), "source": F.lit("internal_compositional_taxonomy_v1"), "license": F.lit("internal"), "seed_hint": F.pmod(F.conv(F.substring(hash_order(seed, "id"), 1, 12), 16, 10).cast("long"), F.lit(2**31 - 1))})
