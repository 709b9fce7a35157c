"""Registered queries of selection operators: orders are episodes, their lines members, chunks or samples; nations are repositories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinetrail.operators import selection as se
from kinetrail.plans.base import rounded, table


def _k() -> Column:
    return F.col("o_orderkey")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each (order, line number)."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber")
    return lines.agg(F.min("l_quantity").cast("bigint").alias("q"), F.min("l_partkey").alias("part"), F.min("l_returnflag").alias("flag"), F.min("l_extendedprice").alias("price")).withColumn("line", F.col("l_linenumber").cast("bigint")).drop("l_linenumber")


_L = "l AS (SELECT l_orderkey, l_linenumber::BIGINT AS line, min(l_quantity)::BIGINT AS q, min(l_partkey) AS part, min(l_returnflag) AS flag, min(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2)"


def repository_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    lock = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("ordinal"), F.col("n_regionkey").cast("string").alias("dataset"), F.col("n_name").alias("repo_id"), F.lower("n_name").alias("local_name"))
    return se.repositories(lock, ["1", "3", "0"], "*[AIa]?[!x]*", 9)


def remote_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("shard-"), (_k() % 7).cast("string"), F.when(_k() % 5 == 0, ".tar.incomplete").otherwise(".tar"))
    files = _orders(spark, sf_dir).select("o_orderkey", F.concat_ws("/", F.concat(F.lit("c"), (_k() % 4).cast("string")), F.lit("sub"), name).alias("path"))
    return se.remote_files(files, ["c1", "c2"], ["shard-3.tar", "shard-5.tar", "shard-5.tar.incomplete"]).withColumn("partial", se.is_partial(F.col("path")))


def newest_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _orders(spark, sf_dir).select("o_custkey", F.lit(150_000.0).alias("launched"), F.col("o_totalprice").alias("changed"), "o_orderkey")
    return se.newest(results, ["o_custkey"], "launched", "changed")


def error_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(_k() % 6 == 0, "GatedRepoError").when(_k() % 6 == 1, "ReadTimeout").when(_k() % 6 == 2, "RepositoryNotFoundError").when(_k() % 6 == 3, "ProxyError").otherwise("HTTPError")
    status = F.when(_k() % 5 == 0, None).otherwise(F.get(F.array(*[F.lit(x) for x in (401, 403, 404, 408, 409, 418, 425, 429, 500, 503)]), (_k() % 10).cast("int")))
    out = se.error_class(name, status, _k() % 7 == 0)
    text = F.concat(F.lit("  call \n with  tok"), (_k() % 3).cast("string"), F.lit("en failed "), F.col("o_orderpriority"))
    return _orders(spark, sf_dir).select("o_orderkey", out["label"].alias("label"), out["retryable"].alias("retryable"), se.redacted(text, ["tok1en", "", "tok2en"], 30).alias("message"))


def first_and_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    members = lines.where("q > 10").select(F.col("l_orderkey").alias("o_orderkey"), F.col("line").alias("archive_ordinal"), F.col("part").cast("string").alias("member"))
    tasks = lines.where("q < 40").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("line") % 3).alias("file_ordinal"), F.col("line").alias("row_ordinal"), F.col("flag").alias("task"))
    return se.with_members(_orders(spark, sf_dir).select("o_orderkey"), members, tasks, "o_orderkey")


def baseline_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("task")).agg(F.avg("c_acctbal").alias("score"))
    fixed = spark.createDataFrame([("BUILDING", "p1", 4000.0), ("BUILDING", "p2", 5000.0), ("MACHINERY", "p1", 4500.0)], "task string, policy string, baseline double")
    return rounded(se.with_baselines(scores, fixed, "task", "score"), 4)


def shard_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    due = _orders(spark, sf_dir).where("o_orderkey % 11 <> 0").select(F.col("o_orderkey").alias("episode"))
    held = _lines(spark, sf_dir).where("line <= 2 AND q > 15").select(F.col("l_orderkey").alias("episode"))
    return se.merged_shards(due, held, "episode")


def shards_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _orders(spark, sf_dir).where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("episode"), "o_totalprice")
    wanted = held.select("episode", (-F.col("episode")).alias("place"))
    return se.in_order(wanted, held, "episode", "place")


def manifest_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of three flags as three manifests of parts."""
    lines = _lines(spark, sf_dir)
    one = [lines.where(F.col("flag") == f).select((F.col("l_orderkey") * 10 + F.col("line")).alias("ordinal"), F.col("part").cast("string").alias("path")) for f in "ANR"]
    return se.union_distinct(*one)


def variant_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ = spark.createDataFrame([("O", "v1", 7), ("O", "v2", 14), ("F", "v1", 8)], "o_orderstatus string, variant string, width int")
    return se.variants(_orders(spark, sf_dir).select("o_orderkey", "o_orderstatus"), table_, ["o_orderstatus"])


def longest_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _lines(spark, sf_dir).groupBy(F.col("l_orderkey").alias("episode")).agg(F.sum("q").alias("frames"))
    return se.longest(se.first_in_order(counts, "episode", 1000), "frames", "episode", 25, need=40, start=20)


def sample_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = _lines(spark, sf_dir).select("l_orderkey", "line")
    return se.sliced(samples, "l_orderkey", "line", skip=1, per_case=3, offset=5, stride=4, most=500)


def memory_ready_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = _lines(spark, sf_dir).select("l_orderkey", "line", F.col("q").alias("start"), F.when(F.col("flag") == "N", "joint_video_action").otherwise("video_only").alias("mode"))
    return se.memory_ready(windows, ["l_orderkey"])


def free_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("gpu"))
    taken = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("bigint").alias("gpu"), (F.col("s_suppkey") % 4).cast("int").alias("slot")).distinct()
    return se.free_slots(workers, 4, taken)


def feedback_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    episodes = _orders(spark, sf_dir).select("o_orderkey", (F.col("o_custkey") % 6).alias("chunks"), (F.col("o_custkey") % 4).alias("start"), (F.col("o_custkey") % 90 + 20).alias("length"))
    return se.feedback_schedule(episodes, "chunks", "start", "length", frames=3, temporal=4, stride=2)


def action_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.action_cursor(_lines(spark, sf_dir).select("l_orderkey", "line", "q"), ["l_orderkey"], "line", "q")


def executed_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label's vectors as the actions of an episode; chunks start at every seventh."""
    order = Window.partitionBy("label").orderBy("vec_id")
    actions = table(spark, sf_dir, "embeddings").select(F.col("label").cast("bigint").alias("label"), (F.row_number().over(order) - 1).cast("bigint").alias("i"), "embedding")
    chunks = actions.where("i % 7 = 0").select("label", (F.col("i") / 7).cast("bigint").alias("chunk"), F.col("i").alias("anchor"))
    out = se.executed(actions, chunks, "label", "i", "embedding", columns=(2, 0, 63))
    return rounded(out.select("label", "chunk", "step", *[F.get("executed", F.lit(k)).cast("double").alias(f"a{k}") for k in range(3)], "short"), 5)


def task_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(se.transition_moments(table(spark, sf_dir, "events"), "event_type", "user_id", "event_id", "value"), 5)


def probe_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    probes = _lines(spark, sf_dir).select(F.col("flag").alias("metric"), "line", F.when(F.col("q") > 9, F.col("price")).alias("v"))
    return rounded(se.probe_means(probes, ["metric"], "line", "v"), 3)


def segment_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = _lines(spark, sf_dir).select("l_orderkey", F.sequence(F.lit(0).cast("bigint"), F.col("q") % 3 + 4).alias("frame_ids"), F.col("flag").alias("text"), (F.col("part") % 9).alias("camera"))
    return se.segment_conflicts(jobs, ["l_orderkey"])


def prompts_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select("l_orderkey", F.when(F.col("q") > 5, F.concat("flag", (F.col("part") % 2).cast("string"))).alias("prompt"), "line")
    return se.prompts_in_order(rows, ["l_orderkey"], "prompt", "line").select("l_orderkey", F.array_join("prompts", ",").alias("prompts"))


def agreed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = _lines(spark, sf_dir).select("l_orderkey", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(8).cast("bigint"))).alias("frame"), (F.col("line") % 2).alias("camera"), F.when(F.col("q") > 8, F.col("flag")).alias("segment"))
    return se.agreed_stab(hits, "l_orderkey", "frame", "camera", "segment", 2)


def contract_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that differ between the lines of an order, twice-used parts and quantities that fall."""
    lines = _lines(spark, sf_dir).withColumn("size", F.when(F.col("q") > 30, F.col("q") % 2))
    drift = se.drifting(lines, ["l_orderkey"], ["flag", "size"]).select("l_orderkey", F.col("column").alias("problem"))
    falls = se.descending(lines, ["l_orderkey"], "line", "q").select("l_orderkey", F.concat(F.lit("falls at "), F.col("line").cast("string")).alias("problem"))
    twice = se.repeated(lines, ["l_orderkey", "flag"]).select("l_orderkey", F.concat("flag", F.lit(" x "), F.col("n").cast("string")).alias("problem"))
    return drift.unionByName(falls).unionByName(twice)


def resume_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _orders(spark, sf_dir).select("o_orderkey", F.col("o_orderstatus").alias("model"), F.when(_k() % 5 == 0, None).otherwise(_k() % 3).alias("seed"))
    wanted = _orders(spark, sf_dir).where("o_orderkey % 7 <> 0").select("o_orderkey", F.lit("O").alias("model"), F.when(_k() % 10 == 0, None).otherwise(F.lit(1)).cast("bigint").alias("seed"))
    return se.resumable(stored, wanted, "o_orderkey", ["seed", "model"]).select("o_orderkey", F.array_join("differs", ",").alias("differs"))


def packed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.transform("embedding", lambda x: x.cast("double"))
    small = se.packed(F.col("v"), [5, 60, 7, 70])
    out = table(spark, sf_dir, "embeddings").select("vec_id", v.alias("v")).withColumn("p", small).withColumn("w", se.widened(F.col("p"), [3, 0, 6, 2], 8)).withColumn("back", se.packed(F.col("w"), [3, 0, 6, 2]))
    moved = se.shifted(F.col("p"))
    return rounded(out.select("vec_id", *[F.get("w", F.lit(k)).alias(f"w{k}") for k in range(8)], F.get("back", F.lit(1)).alias("b1"), F.size(moved["state"]).cast("bigint").alias("n_state"), F.get(moved["action"], F.lit(0)).alias("action_0"), F.get(moved["state"], F.lit(0)).alias("state_0")), 5)


def latent_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("o_orderkey", se.latent_window(F.col("o_custkey") % 60, 21, 5, F.col("o_orderkey")).alias("start"))


def capped_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _lines(spark, sf_dir).groupBy("l_orderkey").agg(F.collect_set("part").alias("p"))
    return parts.select("l_orderkey", F.array_join(se.capped(F.col("p"), 3), ",").alias("first"))


QUERIES = {
    f.__name__: f
    for f in (
        repository_selection, remote_selection, newest_results, error_labels, first_and_last_wins, baseline_deltas, shard_problems, shards_in_order, manifest_union, variant_expansion, longest_episodes, sample_slices, memory_ready_windows,
        free_slots, feedback_schedule, action_cursors, executed_prefixes, task_transitions, probe_means, segment_conflicts, prompts_first_seen, agreed_segments, contract_drift, resume_identity, packed_vectors, latent_windows, capped_missing,
    )
}

_U = "CAST(('0x' || substr({0}, 1, 16))::UBIGINT AS DOUBLE) / 18446744073709551616.0"
_EMB = "e AS (SELECT vec_id, label::BIGINT AS label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, embedding FROM embeddings)"
ORACLE_SQL = {
    "repository_selection": "SELECT n_nationkey::BIGINT AS ordinal, n_regionkey::VARCHAR AS dataset, n_name AS repo_id, lower(n_name) AS local_name FROM nation WHERE n_regionkey IN (0, 1, 3) AND (regexp_full_match(n_name, '.*[AIa].[^x].*') OR regexp_full_match(lower(n_name), '.*[AIa].[^x].*')) ORDER BY n_nationkey LIMIT 9",
    "remote_selection": """WITH f AS (SELECT o_orderkey, o_orderkey % 4 AS c, o_orderkey % 7 AS s, o_orderkey % 5 = 0 AS part FROM orders)
SELECT o_orderkey, 'c' || c || '/sub/shard-' || s || CASE WHEN part THEN '.tar.incomplete' ELSE '.tar' END AS path, part AS partial FROM f WHERE c IN (1, 2) AND (s = 5 OR (s = 3 AND NOT part))""",
    "newest_results": "SELECT o_custkey, 150000.0::DOUBLE AS launched, o_totalprice AS changed, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) AS r FROM orders WHERE o_totalprice >= 149998) WHERE r = 1",
    "error_labels": """WITH x AS (SELECT o_orderkey AS k, o_orderpriority AS p, CASE o_orderkey % 6 WHEN 0 THEN 'gated' WHEN 1 THEN 'net' WHEN 2 THEN 'gone' WHEN 3 THEN 'net' ELSE '' END AS n, CASE WHEN o_orderkey % 5 <> 0 THEN [401, 403, 404, 408, 409, 418, 425, 429, 500, 503][o_orderkey % 10 + 1] END AS s FROM orders),
c AS (SELECT *, CASE WHEN n = 'gated' OR coalesce(s, 0) = 403 THEN 'needs_approval' WHEN s = 401 THEN 'authentication_failed' WHEN n = 'gone' OR coalesce(s, 0) = 404 THEN 'not_found_or_no_access' WHEN s = 429 THEN 'rate_limited' WHEN s >= 400 THEN 'http_' || s WHEN k % 7 = 0 OR n = 'net' THEN 'network_error' ELSE 'error' END AS label FROM x)
SELECT k AS o_orderkey, label, label NOT IN ('needs_approval', 'authentication_failed', 'not_found_or_no_access', 'http_418') AS retryable, substr('call with ' || CASE WHEN k % 3 = 0 THEN 'tok0en' ELSE '<redacted>' END || ' failed ' || p, 1, 30) AS message FROM c""",
    "first_and_last_wins": f"""WITH {_L}, m AS (SELECT l_orderkey, part::VARCHAR AS member, row_number() OVER (PARTITION BY l_orderkey ORDER BY line) AS r FROM l WHERE q > 10), t AS (SELECT l_orderkey, flag, row_number() OVER (PARTITION BY l_orderkey ORDER BY line % 3 DESC, line DESC) AS r FROM l WHERE q < 40)
SELECT o_orderkey, member, flag AS task FROM orders LEFT JOIN (SELECT * FROM m WHERE r = 1) m ON o_orderkey = m.l_orderkey LEFT JOIN (SELECT * FROM t WHERE r = 1) t ON o_orderkey = t.l_orderkey""",
    "baseline_deltas": """WITH b(task, policy, baseline) AS (VALUES ('BUILDING', 'p1', 4000.0::DOUBLE), ('BUILDING', 'p2', 5000.0), ('MACHINERY', 'p1', 4500.0)), s AS (SELECT c_mktsegment AS task, avg(c_acctbal) AS score FROM customer GROUP BY 1)
SELECT task, round(score, 4) AS score, policy, round(baseline, 4) AS baseline, round(score - baseline, 4) AS delta FROM s LEFT JOIN b USING (task)""",
    "shard_problems": f"""WITH {_L}, h AS (SELECT l_orderkey AS k, count(*) AS n FROM l WHERE line <= 2 AND q > 15 GROUP BY 1) SELECT o_orderkey AS episode, 'missing' AS problem FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey NOT IN (SELECT k FROM h)
UNION ALL SELECT k, CASE WHEN k % 11 = 0 OR k NOT IN (SELECT o_orderkey FROM orders) THEN 'unexpected' ELSE 'duplicate' END FROM h WHERE n > 1 OR k % 11 = 0 OR k NOT IN (SELECT o_orderkey FROM orders)""",
    "shards_in_order": "SELECT o_orderkey AS episode, o_totalprice, -o_orderkey AS place FROM orders WHERE o_orderkey % 3 = 0",
    "manifest_union": f"WITH {_L}, x AS (SELECT part::VARCHAR AS path, strpos('ANR', flag) - 1 AS manifest, l_orderkey * 10 + line AS ordinal FROM l) SELECT path, manifest::INT AS manifest, ordinal FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY manifest, ordinal) AS r FROM x) WHERE r = 1",
    "variant_expansion": "WITH v(o_orderstatus, variant, width) AS (VALUES ('O', 'v1', 7), ('O', 'v2', 14), ('F', 'v1', 8)) SELECT o_orderstatus, o_orderkey, variant, width FROM orders LEFT JOIN v USING (o_orderstatus)",
    "longest_episodes": f"WITH {_L} SELECT l_orderkey AS episode, sum(q)::BIGINT AS frames FROM l WHERE l_orderkey < 1000 GROUP BY 1 HAVING sum(q) - 20 >= 40 ORDER BY frames DESC, episode LIMIT 25",
    "sample_slices": f"""WITH {_L}, a AS (SELECT l_orderkey, line, row_number() OVER (PARTITION BY l_orderkey ORDER BY line) - 2 AS i FROM l), b AS (SELECT l_orderkey, line, row_number() OVER (ORDER BY l_orderkey, line) - 6 AS g FROM a WHERE i BETWEEN 0 AND 2)
SELECT l_orderkey, line, g // 4 AS place FROM b WHERE g >= 0 AND g % 4 = 0 AND g // 4 < 500""",
    "memory_ready_windows": f"""WITH {_L}, w AS (SELECT l_orderkey, line, q AS start, CASE WHEN flag = 'N' THEN 'joint_video_action' ELSE 'video_only' END AS mode FROM l), g AS (SELECT l_orderkey, bool_or(start >= 40 AND mode = 'joint_video_action') AS j, bool_or(start >= 40) AS late FROM w GROUP BY 1)
SELECT l_orderkey, line, start, mode FROM w JOIN g USING (l_orderkey) WHERE CASE WHEN j THEN start >= 40 AND mode = 'joint_video_action' WHEN late THEN start >= 40 ELSE true END""",
    "free_slots": "WITH f AS (SELECT n_nationkey::BIGINT AS gpu, slot::INT AS slot FROM nation CROSS JOIN range(0, 4) r(slot) EXCEPT SELECT s_nationkey::BIGINT, (s_suppkey % 4)::INT FROM supplier) SELECT gpu, slot, (row_number() OVER (ORDER BY slot, gpu) - 1)::INT AS place FROM f",
    "feedback_schedule": """WITH o AS (SELECT o_orderkey, o_custkey % 6 AS chunks, o_custkey % 4 AS start, o_custkey % 90 + 20 AS length FROM orders), c AS (SELECT *, unnest(range(0, chunks - 1)) AS chunk FROM o WHERE chunks > 1),
n AS (SELECT *, CASE WHEN chunk = 0 THEN 8 ELSE 12 END AS observations FROM c), f AS (SELECT *, start + 2 * coalesce(sum(observations) OVER (PARTITION BY o_orderkey ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_frame FROM n)
SELECT o_orderkey, chunks, start, length, chunk, observations::BIGINT AS observations, first_frame::BIGINT AS first_frame, (first_frame + 2 * observations - 2)::BIGINT AS last_frame, first_frame + 2 * observations - 2 < length AS inside FROM f""",
    "action_cursors": f"WITH {_L}, c AS (SELECT l_orderkey, line, q, coalesce(sum(q) OVER (PARTITION BY l_orderkey ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS f FROM l) SELECT l_orderkey, line, q, f AS from_step, f + q AS to_step FROM c",
    "executed_prefixes": f"""WITH {_EMB}, c AS (SELECT label, i // 7 AS chunk, i AS anchor, unnest(range(0, 8)) AS step FROM e WHERE i % 7 = 0), n AS (SELECT label, max(i) AS last FROM e GROUP BY 1)
SELECT c.label, chunk, step, round(embedding[3]::DOUBLE, 5) AS a0, round(embedding[1]::DOUBLE, 5) AS a1, round(embedding[64]::DOUBLE, 5) AS a2, anchor + 7 > last AS short FROM c JOIN n USING (label) LEFT JOIN e ON e.label = c.label AND e.i = anchor + step""",
    "task_transitions": """WITH d AS (SELECT event_type, user_id, value - lag(value) OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS d FROM events), n AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2),
t AS (SELECT event_type, count(*) AS episodes, min(n) AS shortest, max(n) AS longest FROM n GROUP BY 1) SELECT event_type, episodes, shortest, longest, count(d)::BIGINT AS transitions, round(avg(d), 5) AS mean, round(stddev_pop(d), 5) AS std FROM d JOIN t USING (event_type) GROUP BY ALL""",
    "probe_means": f"WITH {_L}, p AS (SELECT flag AS metric, line, CASE WHEN q > 9 THEN price END AS v FROM l) SELECT metric, line, round(avg(v), 3) AS mean, count(v) AS n FROM p GROUP BY GROUPING SETS ((metric, line), (metric))",
    "segment_conflicts": f"""WITH {_L}, g AS (SELECT l_orderkey, count(DISTINCT q % 3) AS f, count(DISTINCT flag) AS t, count(*) AS n, count(DISTINCT part % 9) AS c FROM l GROUP BY 1)
SELECT l_orderkey, 'frames_differ' AS problem FROM g WHERE f > 1 UNION ALL SELECT l_orderkey, 'text_differs' FROM g WHERE t > 1 UNION ALL SELECT l_orderkey, 'camera_twice' FROM g WHERE c < n""",
    "prompts_first_seen": f"WITH {_L}, p AS (SELECT l_orderkey, flag || (part % 2) AS p, min(line) AS w FROM l WHERE q > 5 GROUP BY 1, 2) SELECT l_orderkey, string_agg(p, ',' ORDER BY w) AS prompts FROM p GROUP BY 1",
    "agreed_segments": f"""WITH {_L}, g AS (SELECT l_orderkey, count(DISTINCT CASE WHEN q > 8 THEN flag END) = 1 AND count(DISTINCT CASE WHEN q > 8 THEN line % 2 END) = 2 AS agreed, min(CASE WHEN q > 8 THEN flag END) AS s FROM l GROUP BY 1)
SELECT l_orderkey, unnest([0, 4, 8])::BIGINT AS frame, CASE WHEN agreed THEN s END AS segment, agreed FROM g""",
    "contract_drift": f"""WITH {_L}, x AS (SELECT *, CASE WHEN q > 30 THEN q % 2 ELSE -1 END AS size, lag(q) OVER (PARTITION BY l_orderkey ORDER BY line) AS b FROM l)
SELECT l_orderkey, 'flag' AS problem FROM x GROUP BY 1 HAVING count(DISTINCT flag) > 1 UNION ALL SELECT l_orderkey, 'size' FROM x GROUP BY 1 HAVING count(DISTINCT size) > 1 UNION ALL SELECT l_orderkey, 'falls at ' || line FROM x WHERE q < b
UNION ALL SELECT l_orderkey, flag || ' x ' || count(*) FROM x GROUP BY l_orderkey, flag HAVING count(*) > 1""",
    "resume_identity": """SELECT o_orderkey, array_to_string(list_filter([CASE WHEN k % 7 = 0 OR o_orderstatus <> 'O' THEN 'model' END, CASE WHEN k % 7 = 0 OR (CASE WHEN k % 5 = 0 THEN NULL ELSE k % 3 END) IS DISTINCT FROM (CASE WHEN k % 10 = 0 THEN NULL ELSE 1 END) THEN 'seed' END], lambda x: x IS NOT NULL), ',') AS differs
FROM (SELECT *, o_orderkey AS k FROM orders)""",
    "packed_vectors": """WITH v AS (SELECT vec_id, round(embedding[6]::DOUBLE, 5) AS a, round(embedding[61]::DOUBLE, 5) AS b, round(embedding[8]::DOUBLE, 5) AS c FROM embeddings)
SELECT vec_id, b AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2, a AS w3, 0.0::DOUBLE AS w4, 0.0::DOUBLE AS w5, c AS w6, 0.0::DOUBLE AS w7, b AS b1, 3::BIGINT AS n_state, b AS action_0, a AS state_0 FROM v""",
    "latent_windows": f"SELECT o_orderkey, CASE WHEN o_custkey % 60 >= 21 THEN floor({_U.format('sha256(5 || chr(31) || o_orderkey)')} * (o_custkey % 60 - 20))::BIGINT END AS start FROM orders",
    "capped_missing": f"WITH {_L} SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(part)))[1:3], ',') AS first FROM l GROUP BY 1",
}
