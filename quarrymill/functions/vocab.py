"""Vocabulary of the prompt rules. The lists are fixed values of the rules, each in its own order; patterns are built
from them by `words`."""

from __future__ import annotations

import re

# Words that ask for rendered text or a logo; "words?" is a pattern.
TEXT_OR_LOGO = ["text", "font", "letter", "typography", "title", "caption", "words?", "logo", "watermark", "poster", "slogan", "write", "spelled"]

# Brands, people and explicit terms that a raw prompt may not hold.
SENSITIVE_OR_IP = [
    "marilyn monroe", "andrew tate", "daffy duck", "looney", "coca-?cola", "pepsi", "nike", "adidas", "maotai",
    "mac miller", "elon musk", "trump", "biden", "obama", "putin", "xi jinping",
    "jesus", "christ", "muhammad", "buddha",
    "star wars", "harry potter", "marvel", "disney", "pokemon", "spongebob", "mickey mouse",
    "sexy", "nude", "naked", "porn", "erotic",
]

# Words of motion; a prompt with one of these, or of CAMERA, is motion-rich.
MOTION = [
    "walk", "walking", "run", "running", "move", "moving", "fly", "flying", "dance", "dancing", "turn", "turning", "jump", "jumping",
    "ride", "riding", "drive", "driving", "flow", "flowing", "fall", "falling", "rain", "snow", "wave", "waves", "camera", "zoom",
    "pan", "track", "tracking", "chase", "rotate", "rotating", "spin", "spinning", "sway", "drift", "glide", "cross", "approach",
    "leave", "enter", "swim", "swimming", "blink", "blinking", "open", "opening", "close", "closing", "roll", "rolling",
]
CAMERA = ["camera", "shot", "zoom", "pan", "tilt", "track", "tracking", "dolly", "handheld", "close-up", "wide"]

# Subject and scene labels in order of precedence.
SUBJECTS = {
    "human": ["person", "people", "man", "woman", "girl", "boy", "child", "children", "baby", "dancer", "worker", "runner", "crowd", "face", "hand", "hands"],
    "animal": ["cat", "kitten", "dog", "puppy", "horse", "deer", "fox", "bird", "duck", "fish", "animal", "monkey", "bear", "lion", "tiger", "zebra"],
    "vehicle": ["car", "bus", "truck", "train", "airplane", "plane", "ship", "boat", "bicycle", "bike", "scooter", "spaceship", "rocket"],
    "environment": ["ocean", "wave", "waves", "rain", "snow", "storm", "cloud", "clouds", "forest", "mountain", "lake", "river", "waterfall", "grass", "sky"],
    "object": ["cup", "watch", "book", "guitar", "phone", "chair", "table", "camera lens", "machine", "robot", "toy", "object"],
}
SCENES = {
    "indoor": ["room", "kitchen", "bedroom", "studio", "office", "workshop", "house", "home", "indoor", "inside"],
    "city": ["city", "street", "market", "downtown", "building", "traffic", "subway", "station", "urban"],
    "nature": ["forest", "mountain", "meadow", "field", "park", "tree", "trees", "grass", "lake", "river", "beach", "sky", "clouds"],
    "water": ["ocean", "sea", "lake", "river", "waterfall", "rain", "storm", "underwater"],
    "fantasy": ["fantasy", "dragon", "fairy", "magical", "dream", "surreal", "space", "alien", "robotic", "cyberpunk"],
}

# Motion types that have words of their own, in order of precedence.
DYNAMICS = ["rain", "snow", "wave", "waves", "clouds?", "smoke", "mist", "fire", "water", "wind"]
FINE = ["hand", "hands", "tool", "cook", "paint", "draw", "write", "hold", "turning the pages", "assemble"]
HIGH_INTENSITY = ["explosion", "running", "chase", "fast", "rapid", "chaos", "storm", "fight", "crash", "crowd"]

# Challenge tags that have words of their own.
CYCLIC = ["walk", "run", "rain", "snow", "waves?", "spin", "cycle", "dance"]
OCCLUSION = ["behind", "occlud", "disappear", "reappear", "hidden", "through the crowd"]
IDENTITY = ["same", "consistent", "identity", "returning", "again"]
ENTITIES = ["two", "three", "many", "crowd", "people", "animals", "ducklings", "group"]

# Terms that a rewritten prompt may not hold.
PUBLIC_IP = [
    "travis scott", "tupac", "notorious", "dmx", "aaliyah", "spider[- ]?man", "captain america", "sims 4",
    "tim burton", "stanley kubrick", "coca", "nike", "adidas", "pokemon", "goku", "eren yeager", "squidward", "bigfoot",
]
VIOLENT = [
    "confederate", "politician", "president", "atomic explosion", "apocalypse", "corpse", "skull", "blood",
    "bombing", "burning city", "military-style planes", "sexual", "nude", "naked",
]

# Substrings that make a dry-run rewrite an animation.
ANIMATED = ["anime", "cartoon", "clay", "animation", "animated"]

# Fixed patterns of the cleaning rules, without flags.
ATTACHMENT = r"(?:Message:\s*\d+\s*Attachment|<img\b|https?://|cdn\.|discord)"
ASPECT = (
    r"(?:^|\s)(?:--?ar\s*=?\s*\d+:\d+|--?aspect(?:-ratio)?\s*=?\s*\d+:\d+|"
    r"\b\d+:\d+\b|\baspect ratio\b|\bscreen size\b|\bvertical\b|\bhorizontal\b|\bportrait\b|\blandscape\b)"
)
NEGATIVE = r"(?:^|\s)(?:-neg\b|negative prompt|bad anatomy|deformed|extra limb|poorly drawn)"
OPTION = r"(?:^|\s)(?:-motion|-camera|-gs)\s+[^,\.;]+"
NEGATED = r"(?:^|\s)-neg\s+.*$"
COMMAND = r"(?:^|\s)--?[a-z][\w-]*(?:\s+[^,\.;]+)?"
NO_TEXT_SENTENCE = r"\s*(?:ensure|make sure|avoid|with)\s+no\s+(?:readable\s+|visible\s+)?(?:text|logos?|signage|watermarks?)[^.;]*(?:[.;]|$)"
NO_TEXT_INLINE = r"\s*,?\s*(?:and\s+)?no\s+(?:readable\s+|visible\s+)?(?:text|logos?|signage|watermarks?)[^.;,]*"

# Fixed defaults.
NEGATIVE_PROMPT = "low quality, blurry details, text overlay, watermark, logo, overexposed, underexposed, frozen motion, duplicate subject, deformed hands, malformed face, jittery camera, cluttered background"
SAFETY_COLUMNS = ("toxicity", "obscene", "identity_attack", "insult", "threat", "sexual_explicit")

#: Case folds, Unicode classes, and only \n ends a line, as the rules expect.
FLAGS = "(?iUd)"


def literal(terms: list[str]) -> list[str]:
    """The strings that terms stand for: an optional last letter, hyphen or hyphen and blank, with and without."""
    out = []
    for term in terms:
        variants = [term[:-2], term[:-1]] if re.search(r"[a-z]\?$", term) else [term]
        for mark, values in (("[- ]?", ("-", " ", "")), ("-?", ("-", ""))):
            variants = [v.replace(mark, x) for v in variants for x in (values if mark in v else ("",))]
        out += variants
    assert all(re.fullmatch("[a-z][a-z0-9 -]*", v) for v in out), out
    return out


def words(terms: list[str]) -> str:
    """A pattern that holds one of the terms as whole words."""
    return rf"{FLAGS}\b(?:{'|'.join(terms)})\b"
