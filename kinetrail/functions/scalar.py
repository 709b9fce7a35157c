"""Column expressions: identifiers, hashes, rotations, names, numbers. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\x1f"


def finite(x: Column) -> Column:
    """Neither null, NaN nor infinite; NaN sorts above everything in Spark, so it must go before any aggregate."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def number(x: Column) -> Column:
    """A double, NaN for what is no number."""
    return F.coalesce(x.try_cast("double"), F.lit(float("nan")))


def stable_id(*parts: Column, length: int = 24) -> Column:
    """The first hex digits of the SHA-256 of the parts' texts, parted by U+001F; a null part is the text None."""
    texts = [F.coalesce(p.cast("string"), F.lit("None")) for p in parts]
    return F.substring(F.sha2(F.concat_ws(SEPARATOR, *texts), 256), 1, length)


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from the first 64 bits of the same digest."""
    digest = F.sha2(F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(2**64))


def slug(x: Column) -> Column:
    """Small letters, digits, dot, dash and underscore; everything else becomes one dash."""
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9._-]+", "-"), "^-+|-+$", ""), F.lit("")), F.lit("unknown"))


def chunk_path(template: str, chunk_size: Column, episode: Column) -> Column:
    """A path from a printf template that takes the chunk (episode div size) and the episode."""
    return F.format_string(template, F.floor(episode / F.greatest(chunk_size, F.lit(1))).cast("bigint"), episode)


def rate(text: Column) -> Column:
    """Frames a second from "30000/1001", "25" and the like; null for "0/0", "N/A" and rates that are not positive."""
    parts = F.split(text, "/")
    top, low = F.get(parts, F.lit(0)).try_cast("double"), F.when(F.size(parts) > 1, F.get(parts, F.lit(1)).try_cast("double")).otherwise(F.lit(1.0))
    value = F.try_divide(top, low)
    return F.when(value > 0, value)


def base26(text: Column) -> Column:
    """The number of a split-archive suffix: aa is 0, ab is 1, ba is 26; null if it isn't small letters."""
    digits = F.transform(F.split(text, ""), lambda ch: F.ascii(ch) - F.lit(97))
    return F.when(text.rlike("^[a-z]+$"), F.aggregate(digits, F.lit(0), lambda s, d: s * 26 + d))


def spaced(x: Column) -> Column:
    """White space collapsed to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def prompts(tasks: Column, least: int = 2) -> dict[str, Column]:
    """Normalised distinct prompts in first-seen order and the first usable one."""
    found = F.array_distinct(F.filter(F.transform(F.coalesce(tasks, F.array().cast("array<string>")), lambda x: spaced(F.coalesce(x, F.lit("None")))), lambda x: x != ""))
    usable = F.filter(found, lambda x: F.length(x) >= least)
    return {"prompts": found, "primary_prompt": F.get(usable, F.lit(0)), "usable": F.size(usable) > 0}


def prompt_or_namespace(tasks: Column, namespace: Column) -> Column:
    """The first prompt, else the namespace with slashes and underscores read as spaces."""
    first = F.get(prompts(tasks, 1)["prompts"], F.lit(0))
    return F.coalesce(first, F.nullif(F.trim(F.regexp_replace(namespace, "[_/]+", " ")), F.lit("")))


# --- rotations -----------------------------------------------------------------------------------


def _principal(x: Column, y: Column, z: Column, w: Column) -> Column:
    """Rotation vector of a unit quaternion, of the least angle."""
    length = F.sqrt(x * x + y * y + z * z)
    angle = F.lit(2.0) * F.atan2(length, w)
    angle = F.when(angle > math.pi, angle - 2 * math.pi).otherwise(angle)
    scale = F.when(length <= 1e-12, F.lit(0.0)).otherwise(angle / length)
    return F.array(x * scale, y * scale, z * scale)


def rpy_to_rotvec(roll: Column, pitch: Column, yaw: Column) -> Column:
    """Rotation vector of roll, pitch and yaw (about x, then y, then z)."""
    (cr, sr), (cp, sp), (cy, sy) = ((F.cos(a / 2), F.sin(a / 2)) for a in (roll, pitch, yaw))
    return _principal(sr * cp * cy - cr * sp * sy, cr * sp * cy + sr * cp * sy, cr * cp * sy - sr * sp * cy, cr * cp * cy + sr * sp * sy)


def quaternion_to_rotvec(x: Column, y: Column, z: Column, w: Column) -> Column:
    """Rotation vector of a quaternion of any length; one of no length is an error."""
    norm = F.sqrt(x * x + y * y + z * z + w * w)
    norm = F.when(norm <= 1e-12, F.raise_error(F.lit("quaternion of no length")).cast("double")).otherwise(norm)
    return _principal(x / norm, y / norm, z / norm, w / norm)


def relative_pose(pose: list[Column], base: list[Column]) -> Column:
    """[x, y, z, qx, qy, qz, qw] of a pose seen from a base pose: offset of the places, inverse base rotation before the own."""
    x, y, z, w = pose[3:]
    a, b, c, d = -base[3], -base[4], -base[5], base[6]
    turned = [d * x + a * w + b * z - c * y, d * y - a * z + b * w + c * x, d * z + a * y - b * x + c * w, d * w - a * x - b * y - c * z]
    return F.array(*[p - q for p, q in zip(pose[:3], base[:3], strict=True)], *turned)


# --- names ------------------------------------------------------------------------------------------

# Camera roles by what a key contains, in order.
CAMERA_ROLES = (
    ("left_wrist", ("left_wrist", "wrist_left", "hand_left", "left_hand", "left_handeye")),
    ("right_wrist", ("right_wrist", "wrist_right", "hand_right", "right_hand", "right_handeye")),
    ("global_secondary", ("head_right", "right_head", "camera_right", "side", "external_right", "camera_left", "external_left")),
    ("global_primary", ("head", "front", "top", "external", "overview", "agentview", "image", "rgb")),
    ("auxiliary", ("chest", "handeye", "rear", "back", "aux")),
)


def snake(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def camera_role(key: Column) -> Column:
    """The first role one of whose words the key contains; auxiliary if none."""
    name = snake(key)
    return F.coalesce(*[F.when(name.rlike("|".join(words)), F.lit(role)) for role, words in CAMERA_ROLES], F.lit("auxiliary"))


# Words that say a signal is a velocity.
VELOCITY_WORDS = ("velocity", "velocities", "speed", "twist", "_vel", "delta_", "_delta")


def is_velocity(*texts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *[F.coalesce(t.cast("string"), F.lit("")) for t in texts])).rlike("|".join(VELOCITY_WORDS))


def with_canonical_slot(features, name: str, kind: Column, key: str, into: str = "match"):
    """features with a struct (slot, semantic, confidence) for each feature name, null if no rule knows it.

    80 slots: left and right end effector, gripper, joints and hands, then base, torso and head. Rules apply in order, the first that
    matches decides. Shared parts of the rules are columns of their own, so that the rules stay small."""
    kept = [x for x in features.columns if x != into]
    value, context, side, axis = (F.col(x) for x in ("__value__", "__context__", "__side__", "__axis__"))

    def side_of(x: Column) -> Column:
        return F.when(x.contains("left"), F.lit("left")).when(x.contains("right"), F.lit("right"))

    rows = features.select(*kept, kind.alias("__kind__"), snake(F.col(name)).alias("__value__"), snake(F.coalesce(F.col(key), F.lit(""))).alias("__context__"))
    rows = rows.withColumn("__side__", F.coalesce(side_of(value), side_of(context)))
    rows = rows.withColumn("__axis__", F.nullif(F.regexp_extract(value, "(?:^|_)([xyz])(?:_[a-z]+)?$", 1), F.lit("")))
    left, step = side == "left", F.instr(F.lit("xyz"), axis) - 1

    def made(cond: Column, slot: Column, semantic: Column, confidence: str = "high") -> Column:
        return F.when(cond, F.struct(slot.cast("int").alias("slot"), semantic.alias("semantic"), F.lit(confidence).alias("confidence")))

    def index(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(value, pattern, 1), F.lit("")).try_cast("int")

    def joint(n: Column, cond: Column) -> Column:
        return made(cond & side.isNotNull() & n.between(0, 6), F.when(left, 14).otherwise(21) + n, F.concat(side, F.lit("_joint_"), n + 1))

    def twist(part: str, base: int, semantic: str) -> Column:
        pattern = f"{part}_twist_(linear|angular)_([xyz])$"
        way, ax = F.regexp_extract(value, pattern, 1), F.regexp_extract(value, pattern, 2)
        return made(way != "", F.lit(base - 1) + F.when(way == "linear", 0).otherwise(3) + F.instr(F.lit("xyz"), ax), F.concat(F.lit(semantic), way, F.lit("_"), ax))

    grip = value.contains("gripper") & (value.rlike("open|position|command|target|state") | context.rlike("gripper|effector_position"))
    tool = value.rlike("eef|ee_|tcp|end_effector") & side.isNotNull() & axis.isNotNull() & ((F.col("__kind__") == "state") | value.rlike("delta|relative"))
    place = value.rlike("(^|_)(pos|position)(_|$)|world_vector")
    start = F.when(left, 0).otherwise(7)
    drive = F.regexp_extract(value, "(?:base|chassis)_(?:velocity|vel|twist|delta)_([xyz])$", 1)
    body, bent = index(r"(?:torso|waist|head)_(?:joint_)?(\d+)") - 1, index(r"(?:torso|waist|head)_position_(\d+)")
    rules = [
        made(side.isNotNull() & grip, F.when(left, 6).otherwise(13), F.concat(side, F.lit("_gripper"))),
        joint(index(r"(?:left|right)_joint_(\d+)$"), context.contains(F.concat(side, F.lit("_joint_position")))),
        joint(index(r"(?:arm_)?joint_(\d+)") - 1, F.lit(True)),
        joint(index(r"(?:arm_left|arm_right|left_arm|right_arm)_position_(\d+)"), F.lit(True)),
        joint(index(r"(?:left|right)_arm_(\d+)(?:_|$)"), context.contains("joint")),
        made(tool & place, start + step, F.concat(side, F.lit("_ee_position_"), axis), "medium"),
        made(tool & value.rlike("rotvec|rotation_vector"), start + step + 3, F.concat(side, F.lit("_ee_rotation_vector_"), axis), "medium"),
        made(drive != "", F.lit(51) + F.instr(F.lit("xyz"), drive), F.lit("mobile_base")),
        twist("chassis", 52, "mobile_base_"),
        made(body.between(0, 5), 58 + body, F.lit("torso_head")),
        made(bent.between(0, 5), 58 + bent, F.concat(F.lit("torso_head_position_"), bent)),
        twist("(?:torso|waist|head)", 58, "torso_head_"),
        made(context.contains("waist") & (value == "pitch"), F.lit(58), F.lit("waist_pitch")),
        made(context.contains("waist") & (value == "lift"), F.lit(59), F.lit("waist_lift")),
        made(context.contains("head") & (value == "yaw"), F.lit(60), F.lit("head_yaw")),
        made(context.contains("head") & value.isin("pitch", "patch"), F.lit(61), F.lit("head_pitch")),
    ]
    numbered = rows.select("*", *[r.alias(f"__r{i}__") for i, r in enumerate(rules)])
    return numbered.select(*kept, F.coalesce(*[F.col(f"__r{i}__") for i in range(len(rules))]).alias(into))
