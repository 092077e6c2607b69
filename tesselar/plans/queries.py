"""The registered queries: every operator on the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselar.operators import (
    alarms,
    dsgd,
    evaluate,
    factors,
    grid,
    health,
    livelist,
    loadlog,
    membership,
    scaling,
)
from tesselar.operators.cuts import fitting_cuts, id_counts
from tesselar.operators.skew import ROWS_PER_BLOCK, ROWS_PER_TASK
from tesselar.plans import views
from tesselar.plans.files import score_files as score_factor_files
from tesselar.plans.files import train_files as train_to_files
from tesselar.plans.train import TrainingParams, train_factors
from tesselar.sources import factors as factor_files
from tesselar.sources import logs
from tesselar.sources import ratings as rating_files
from tesselar.sources.lines import numbered_lines
from tesselar.streaming.alarms import stream_metric_alarm
from tesselar.streaming.decisions import stream_scaling_decisions
from tesselar.streaming.run import run_available
from tesselar.workspace import materialize, new_path

RANK = 8
BLOCKS = 4
SEED = 1
OFFSET = 1
PERIOD = 6 * 3600
SCALING = scaling.ScalingParams(
    upper=55.0, lower=45.0, min_size=1, max_size=4, period=PERIOD, count=2, cooldown=2 * PERIOD
)
HEALTH_RUNS = (2, 2)
NO_BALANCER = -1
PHRASE = "the the"
# The order of lines in the rating file of the queries that train in file order.
LINE_ORDER = "(i * 7919 + j * 104729) % 1000003, i, j, r"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(column: str | Column, digits: int = 6) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, digits)


# Rows of a chunk in the queries that show the way of hot keys.
HOT_ROWS = 50


def _written_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived ratings as a table, for queries that read them more than once."""
    return materialize(views.ratings(spark, sf_dir), "ratings")


def _blocked(spark: SparkSession, sf_dir: str, ratings: DataFrame | None = None) -> DataFrame:
    return grid.assign_blocks(ratings or _written_ratings(spark, sf_dir), BLOCKS)


def _start_factors(ratings: DataFrame) -> DataFrame:
    return factors.init_factors(factors.observed_ids(ratings), RANK, SEED)


def _keyed_factors(ratings: DataFrame, offset: int) -> tuple[DataFrame, DataFrame]:
    """User and item ids with the row block they take part in at a stratum."""
    extent = grid.matrix_extent(ratings)
    whole = grid.Grid(BLOCKS, extent.select("max_i").scalar(), extent.select("max_j").scalar())
    users = grid.distinct_entities(ratings, "i").withColumn("key", whole.row_block(F.col("id")))
    items = grid.distinct_entities(ratings, "j").withColumn("cb", whole.col_block(F.col("id")))
    return users, grid.rotate_items(items, offset, BLOCKS)


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = alarms.metric_period_stats(views.metrics(spark, sf_dir), PERIOD)
    return materialize(stats, "period-stats")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alarms.threshold_label(
        alarms.last_n_avg(_stats(spark, sf_dir)), SCALING.upper, SCALING.lower
    )


def _adds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        views.events(spark, sf_dir)
        .filter(F.col("event_type") == "signup")
        .select("ts", F.col("user_id").alias("instance"))
    )


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = views.events(spark, sf_dir).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("dim"), "value"
    )


# Sources and sinks


@query
def ratings_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "rating-lines")
    views.rating_lines(spark, sf_dir).write.text(path)
    return rating_files.read_ratings(spark, path)


def _movielens(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    path = new_path(spark, table)
    views.rated_files(spark, sf_dir)[table].write.text(path)
    return rating_files.read_movielens(spark, path, table)


@query
def movielens_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _movielens(spark, sf_dir, "ratings")


@query
def movielens_scan_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _movielens(spark, sf_dir, "users")


@query
def movielens_scan_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    movies = _movielens(spark, sf_dir, "movies")
    return movies.select("movie_id", "title", F.explode("genres").alias("genre"))


@query
def line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "rating-lines")
    views.rating_lines(spark, sf_dir).write.text(path)
    return rating_files.line_count(spark, path)


@query
def factors_to_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of both roles as they stand in their files, by line number."""
    start = materialize(_start_factors(views.ratings(spark, sf_dir)), "factors")
    lines = []
    for role in factors.AXES:
        path = new_path(spark, "factor-lines")
        factor_files.write_factors_csv(start, path, role, digits=6)
        lines.append(numbered_lines(spark, path).select(F.lit(role).alias("role"), "number", "line"))
    return lines[0].unionAll(lines[1])


@query
def factors_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both roles, written to their files and read back."""
    start = materialize(_start_factors(views.ratings(spark, sf_dir)), "factors")
    return _vector_rows(_written_factors(spark, start))


def _written_factors(spark: SparkSession, model: DataFrame) -> DataFrame:
    """Factors written to a file for each role and read back."""
    read = []
    for role in factors.AXES:
        path = new_path(spark, "factor-lines")
        factor_files.write_factors_csv(model, path, role)
        read.append(factor_files.read_factors_csv(spark, path, role))
    return read[0].unionAll(read[1])


@query
def blocks_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "blocks")
    rating_files.write_blocks(_blocked(spark, sf_dir).drop("s"), path)
    return rating_files.read_blocks(spark, path)


@query
def load_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = views.table(spark, sf_dir, "documents")
    return logs.explode_log(documents.select(F.col("doc_id").alias("run_id"), "text"))


# Projections and predicates


@query
def row_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blocked(spark, sf_dir).select("i", "rb")


@query
def col_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blocked(spark, sf_dir).select("j", "cb")


@query
def block_one_based(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = _written_ratings(spark, sf_dir)
    return grid.assign_blocks(ratings, BLOCKS, base=1).select("i", "j", "rb", "cb")


@query
def stratum_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.select_stratum(_blocked(spark, sf_dir), OFFSET)


@query
def rotate_item_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_factors(_written_ratings(spark, sf_dir), OFFSET)[1]


@query
def predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = _written_ratings(spark, sf_dir)
    joined = evaluate.rating_factor_join(ratings, _start_factors(ratings))
    return evaluate.predict(joined, RANK).select("i", "j", "r", _rounded("prediction").alias("prediction"))


@query
def log_id_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loadlog.log_id_extract(views.responses(spark, sf_dir))


@query
def text_contains_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loadlog.text_contains_flag(views.responses(spark, sf_dir), PHRASE)


@query
def threshold_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select("dim", "t", "label")


@query
def member_ip_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members' addresses in seven spellings, valid and not."""
    user = F.col("user_id")
    hexed = F.lower(F.hex(user))
    spellings = [
        F.concat(F.lit("10.0."), F.floor(user / 256), F.lit("."), user % 256),
        F.concat(F.lit("10."), user, F.lit(".0.1")),
        F.concat(F.lit("2001:db8::"), hexed),
        F.concat(F.lit("1:2:3:4:5:6:7:"), hexed),
        F.concat(F.lit("::ffff:10.0.0."), user),
        F.concat(F.lit("1::2::"), hexed),
        F.concat(F.lit("host-"), user),
    ]
    kind = (F.col("event_id") % len(spellings)).cast("int")
    checked = views.events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), F.array(*spellings)[kind].alias("ip")
    )
    return membership.member_ip_check(checked)


# Joins


@query
def block_factor_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.block_factor_join(*_keyed_factors(_written_ratings(spark, sf_dir), OFFSET))


@query
def block_data_right_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = _written_ratings(spark, sf_dir)
    wh = grid.block_factor_join(*_keyed_factors(ratings, OFFSET)).select("key", "w_rows", "h_rows")
    blocked = grid.select_stratum(_blocked(spark, sf_dir, ratings), OFFSET)
    return grid.block_data_right_join(blocked, wh)


@query
def block_cogroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = _written_ratings(spark, sf_dir)
    blocked = grid.select_stratum(_blocked(spark, sf_dir, ratings), OFFSET)
    return grid.block_cogroup_counts(blocked, *_keyed_factors(ratings, OFFSET))


@query
def rating_factor_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = _written_ratings(spark, sf_dir)
    joined = evaluate.rating_factor_join(ratings, _start_factors(ratings))
    both = joined.select("i", "j", "r", F.posexplode(F.arrays_zip("w", "h")).alias("k", "both"))
    return both.select("i", "j", "r", "k", _rounded("both.w").alias("w"), _rounded("both.h").alias("h"))


# Aggregations


@query
def matrix_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.matrix_extent(views.ratings(spark, sf_dir))


@query
def distinct_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factors.observed_ids(views.ratings(spark, sf_dir))


@query
def block_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.block_sizes(_blocked(spark, sf_dir))


@query
def block_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = _written_ratings(spark, sf_dir)
    errors = evaluate.block_error(ratings, _start_factors(ratings), grid.measured_grid(ratings, BLOCKS))
    return errors.withColumn("squared_error", _rounded("squared_error"))


@query
def model_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = _written_ratings(spark, sf_dir)
    error = evaluate.model_error(ratings, _start_factors(ratings), BLOCKS)
    return error.withColumns({name: _rounded(name) for name in ("squared_error", "rmse")})


@query
def score_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model error again, with factors and ratings written to text files and read back."""
    home = new_path(spark, "scored")
    ratings = _written_ratings(spark, sf_dir)
    start = factors.init_factors(factors.dense_ids(ratings), RANK, SEED)
    for role in ("W", "H"):
        factor_files.write_factors_csv(start, f"{home}/{role}", role)
    ratings.select(F.concat_ws(",", "i", "j", "r")).write.text(f"{home}/ratings")
    error = score_factor_files(spark, f"{home}/W", f"{home}/H", f"{home}/ratings")
    return error.withColumns({name: _rounded(name) for name in ("squared_error", "rmse")})


@query
def last_minute_rps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = loadlog.last_minute_rps(views.load_log(spark, sf_dir))
    return rates.withColumn("rps", _rounded("rps"))


@query
def metric_period_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = alarms.metric_period_stats(views.metrics(spark, sf_dir), PERIOD)
    return stats.withColumns({name: _rounded(name) for name in ("average", "duration")})


@query
def tumbling_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alarms.tumbling_alarm(views.metrics(spark, sf_dir))
    return found.withColumn("average", _rounded("average"))


@query
def first_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loadlog.first_reach(views.load_steps(spark, sf_dir))


# Order-dependent analytics


@query
def last3_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = alarms.last_n_avg(_stats(spark, sf_dir), 3)
    return recent.select("dim", "t", _rounded("last_avg").alias("last_avg"))


@query
def breach_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = alarms.breach_counters(_labelled(spark, sf_dir))
    return counted.select("dim", "t", "label", "up", "down")


@query
def health_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    up, down = HEALTH_RUNS
    states = health.health_state(views.probes(spark, sf_dir), up, down)
    return states.select("instance", "ts", "seq", "state")


@query
def health_state_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = health.health_state(views.probes(spark, sf_dir))
    return states.select("instance", "ts", "seq", "state")


@query
def evict_first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.evict_first_failure(views.probes(spark, sf_dir), _adds(spark, sf_dir))


@query
def active_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership.active_members(views.members(spark, sf_dir))


@query
def member_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership.member_names(views.members(spark, sf_dir))


@query
def member_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answers of all balancers, and of one more that never had a request."""
    members = views.members(spark, sf_dir)
    active = materialize(membership.active_members(members), "members")
    asked = members.select(F.explode(F.array("balancer", F.lit(NO_BALANCER))).alias("balancer"))
    return membership.member_list(active, balancers=asked)


def _live_members(spark: SparkSession, sf_dir: str, rows_per_chunk: int) -> DataFrame:
    """Entries of the live list; -1 for those that never left it."""
    entries = livelist.live_members(views.member_events(spark, sf_dir), rows_per_chunk)
    return entries.withColumn("left_at", F.coalesce("left_at", F.lit(-1).cast("long")))


@query
def live_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _live_members(spark, sf_dir, ROWS_PER_TASK)


@query
def live_members_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _live_members(spark, sf_dir, HOT_ROWS)


@query
def live_member_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return livelist.live_member_list(views.member_events(spark, sf_dir))


@query
def round_robin_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = materialize(membership.active_members(views.members(spark, sf_dir)), "members")
    return membership.round_robin_assign(views.requests(spark, sf_dir), active)


# Sorted factors


@query
def factors_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both roles, each in id order."""
    start = materialize(_start_factors(views.ratings(spark, sf_dir)), "factors")
    ordered = [_vector_rows(factors.factors_sorted(start, role)) for role in factors.AXES]
    return ordered[0].unionAll(ordered[1])


@query
def factors_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = materialize(_start_factors(views.ratings(spark, sf_dir)), "factors")
    heads = [_vector_rows(factors.factors_head(start, role)) for role in factors.AXES]
    return heads[0].unionAll(heads[1])


# Factorization


@query
def init_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = _start_factors(views.ratings(spark, sf_dir))
    return _vector_rows(start, digits=9)


@query
def init_factors_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = factors.init_factors(factors.dense_ids(_written_ratings(spark, sf_dir)), RANK, SEED)
    return _vector_rows(start, digits=9)


@query
def fill_missing_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and items of the high ratings have vectors, all others get theirs from a new seed."""
    ratings = _written_ratings(spark, sf_dir)
    known = _start_factors(ratings.filter(F.col("r") >= 5))
    filled = factors.fill_missing_factors(known, factors.observed_ids(ratings), RANK, SEED + 2)
    return _vector_rows(filled, digits=9)


def _learned_stratum(spark: SparkSession, sf_dir: str, update: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """The factors after stratum ``OFFSET`` of the fixed grid, in as many turns as its strips need."""
    ratings = _written_ratings(spark, sf_dir)
    params = TrainingParams(rank=RANK, blocks=BLOCKS)
    cuts = fitting_cuts(grid.measured_grid(ratings, BLOCKS), id_counts(ratings), rows_per_block, ratings)
    layout = dsgd.block_layout(ratings, cuts, rows_per_block=rows_per_block)
    turns = cuts.stratum_turns(OFFSET)
    store = dsgd.FactorStore(layout, _start_factors(ratings), turns[0])
    for turn in turns:
        store.write(dsgd.dsgd_update(layout, store.read(), turn, params.eta, update))
    store.drop()
    layout.drop()
    # The strips are those of blocks.
    block = F.element_at(F.lit(cuts.row_blocks.tolist()), F.col("key") + 1).cast("int")
    return store.files().withColumn("key", block)


def _vector_rows(model: DataFrame, *more: str, digits: int = 6) -> DataFrame:
    """Every value of every vector."""
    values = model.select("role", "id", *more, F.posexplode_outer("vec").alias("k", "value"))
    return values.withColumn("value", _rounded("value", digits))


def _trained(spark: SparkSession, sf_dir: str, params: TrainingParams) -> DataFrame:
    return _vector_rows(train_factors(_written_ratings(spark, sf_dir), params)[0])


# Ratings of a sub-block in the queries that cut blocks.
CUT_ROWS = 500


@query
def factor_regroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The factors after a sub-epoch, keyed for the next one."""
    return _vector_rows(_learned_stratum(spark, sf_dir, "simultaneous"), "key")


@query
def dsgd_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector_rows(_learned_stratum(spark, sf_dir, "simultaneous"))


@query
def sgd_update_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector_rows(_learned_stratum(spark, sf_dir, "sequential"))


@query
def dsgd_update_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sub-epoch with blocks cut into strips."""
    return _vector_rows(_learned_stratum(spark, sf_dir, "simultaneous", CUT_ROWS))


@query
def sgd_update_sequential_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector_rows(_learned_stratum(spark, sf_dir, "sequential", CUT_ROWS))


@query
def train_factors_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trained(spark, sf_dir, TrainingParams(rank=RANK, blocks=BLOCKS, epochs=2, rows_per_block=CUT_ROWS))


@query
def train_factors_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trained(spark, sf_dir, TrainingParams(rank=RANK, blocks=BLOCKS, epochs=2))


@query
def train_row_major(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two epochs that visit the blocks row by row, with the single-machine update rule."""
    return _trained(spark, sf_dir, replace(TrainingParams.out_of_core(RANK, BLOCKS), epochs=2))


def _ordered_file(spark: SparkSession, sf_dir: str) -> str:
    """The ratings as a text file in an order of its own."""
    path = new_path(spark, "rating-lines")
    ratings = views.ratings(spark, sf_dir).orderBy(*[F.expr(part) for part in LINE_ORDER.split(", ")])
    ratings.select(F.concat_ws(",", "i", "j", "r")).write.text(path)
    return path


@query
def train_line_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An epoch over a rating file, the samples of a block in the order of their lines."""
    ratings = materialize(rating_files.read_numbered_ratings(spark, _ordered_file(spark, sf_dir)), "ratings")
    params = TrainingParams(rank=RANK, blocks=BLOCKS, epochs=1, order=("number",))
    return _vector_rows(train_factors(ratings, params)[0])


@query
def train_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a rating file to both factor files: the lines of every id, rated or not, read back."""
    home = new_path(spark, "trained")
    params = TrainingParams(rank=RANK, blocks=BLOCKS, epochs=1)
    train_to_files(spark, _ordered_file(spark, sf_dir), f"{home}/W", f"{home}/H", params)
    w, h = (factor_files.read_factors_csv(spark, f"{home}/{role}", role) for role in factors.AXES)
    return _vector_rows(w.unionAll(h))


@query
def training_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = TrainingParams(rank=RANK, blocks=BLOCKS, epochs=2)
    log = train_factors(_written_ratings(spark, sf_dir), params)[1]
    return log.select("iteration", _rounded("squared_error").alias("squared_error"), _rounded("rmse").alias("rmse"))


# State machines and streams


@query
def scaling_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaling.scaling_decisions(_labelled(spark, sf_dir), SCALING)


@query
def policy_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alarms.tumbling_alarm(views.metrics(spark, sf_dir))
    return scaling.policy_actions(materialize(found, "alarms"))


@query
def stream_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_available(stream_metric_alarm(_event_stream(spark, sf_dir)), "stream-alarms")
    return found.select(
        "rule", "dim", F.col("t").cast("timestamp_ntz").alias("t"), _rounded("average").alias("average"), "adjustment"
    )


@query
def stream_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = stream_scaling_decisions(_event_stream(spark, sf_dir), SCALING)
    decided = run_available(stream, "stream-decisions")
    return decided.select(
        "dim", F.col("t").cast("timestamp_ntz").alias("t"), "label", "size", "action"
    )


# The same operators with keys cut into chunks, as above ROWS_PER_TASK rows


@query
def last3_avg_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = alarms.last_n_avg(_stats(spark, sf_dir), 3, HOT_ROWS)
    return recent.select("dim", "t", _rounded("last_avg").alias("last_avg"))


@query
def breach_counters_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = alarms.breach_counters(_labelled(spark, sf_dir), HOT_ROWS)
    return counted.select("dim", "t", "label", "up", "down")


@query
def active_members_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership.active_members(views.members(spark, sf_dir), HOT_ROWS)


@query
def member_names_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership.member_names(views.members(spark, sf_dir), HOT_ROWS)


@query
def scaling_decisions_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaling.scaling_decisions(_labelled(spark, sf_dir), SCALING, HOT_ROWS)


@query
def health_state_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    up, down = HEALTH_RUNS
    states = health.health_state(views.probes(spark, sf_dir), up, down, HOT_ROWS)
    return states.select("instance", "ts", "seq", "state")


@query
def round_robin_assign_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = materialize(membership.active_members(views.members(spark, sf_dir)), "members")
    return membership.round_robin_assign(views.requests(spark, sf_dir), active, HOT_ROWS)


@query
def policy_actions_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alarms.tumbling_alarm(views.metrics(spark, sf_dir))
    return scaling.policy_actions(materialize(found, "alarms"), rows_per_chunk=HOT_ROWS)


@query
def last_minute_rps_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = loadlog.last_minute_rps(views.load_log(spark, sf_dir), HOT_ROWS)
    return rates.withColumn("rps", _rounded("rps"))


@query
def model_error_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = _written_ratings(spark, sf_dir)
    error = evaluate.model_error(ratings, _start_factors(ratings), BLOCKS, CUT_ROWS)
    return error.withColumns({name: _rounded(name) for name in ("squared_error", "rmse")})


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One epoch of training from fresh factors: iteration, squared error, RMSE."""
    params = TrainingParams(rank=RANK, blocks=BLOCKS, epochs=1)
    log = train_factors(_written_ratings(spark, sf_dir), params)[1]
    return log.select("iteration", "squared_error", "rmse")


# Keys of the survey where a Python name would shadow an imported function.
QUERIES["train_factors"] = QUERIES.pop("train_factors_model")
QUERIES["stream_metric_alarm"] = QUERIES.pop("stream_alarm")
QUERIES["stream_scaling_decisions"] = QUERIES.pop("stream_decisions")
