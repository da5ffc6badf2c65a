"""Every operator as a query over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.ml.regression import LinearRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import DIRTY, RAW, catalogue, gapped, gapped_sql, producer_sql, table
from shelfmark.functions import codec, repair, text
from shelfmark.functions.commands import returns_rows
from shelfmark.operators import changes, commands, density, describe, exact, metrics, report, snapshot, split, terms, topk
from shelfmark.plans import features, flow, moments, training, weighted
from shelfmark.session import materialize, scratch_path
from shelfmark.sinks import publish
from shelfmark.sources import files, ranges
from shelfmark.streaming.compact import BatchTable
from shelfmark.streaming.ingest import ingest_available
from shelfmark.streaming.merge import MergedTable, merge_available

Query = Callable[[SparkSession, str], DataFrame]

PLACES = 6


def _rounded(df: DataFrame, *columns: str, places: int = PLACES) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name in columns})


def _surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label and a prediction for operators that only need the two."""
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        F.col("l_extendedprice").alias("eclassnumber"),
        (F.col("l_quantity") * 2000).alias("prediction"),
        "l_returnflag",
    )


def _description_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of which the descriptions' terms are windows of `TERM_WORDS`."""
    return catalogue(spark, sf_dir).select("id", text.catalogue_terms(F.col("description"), 1).alias("words"))


TERM_WORDS = features.DESCRIPTION.n


def _description_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = text.catalogue_terms(F.col("description"), 5)
    return catalogue(spark, sf_dir).select("id", kept.alias("terms"))


def _category_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = text.catalogue_terms(F.col("category"), 1)
    return catalogue(spark, sf_dir).select("id", kept.alias("terms"))


def _token_rows(spark: SparkSession, sf_dir: str, words: Column) -> DataFrame:
    return terms.term_rows(catalogue(spark, sf_dir).select("id", words.alias("words")), "id", "words")


# Sources


def full_scan(spark, sf_dir):
    """The producer's table read whole, under the producer's names."""
    path = scratch_path(spark, "producer")
    codec.to_producer_names(catalogue(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


def decode_nulls(spark, sf_dir):
    return codec.decode_nulls(gapped(spark, sf_dir))


def text_lines(spark, sf_dir):
    """Lines of a dump whose descriptions hold line breaks: one record becomes several."""
    path = scratch_path(spark, "dump")
    publish.text_dump(codec.encode_lines(catalogue(spark, sf_dir, RAW)), path)
    return files.text_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def parquet_schema_scan(spark, sf_dir):
    """Declared columns only: an extra one is skipped, an absent one is NULL."""
    path = scratch_path(spark, "table")
    written = catalogue(spark, sf_dir).drop("taric")
    written.withColumn("timestamp", F.current_timestamp()).write.parquet(path)
    return files.parquet_table(spark, path)


def read_batch(spark, sf_dir):
    """Two batches written, the second one read."""
    root = scratch_path(spark, "batches")
    whole = catalogue(spark, sf_dir)
    for batch in range(2):
        whole.withColumn("eclassnumber", F.col("eclassnumber") + batch).write.parquet(
            f"{root}/batch_{batch}"
        )
    return files.read_batch(spark, root, 1)


def stream_ingest(spark, sf_dir):
    """Dump, stream the files in several micro-batches, read every batch back."""
    dump, root = scratch_path(spark, "dump"), scratch_path(spark, "batches")
    lines = publish.snapshot_records(catalogue(spark, sf_dir))
    publish.text_dump(lines, dump)
    stream = files.text_stream(spark, dump, files_per_batch=3)
    ingest_available(stream, root, scratch_path(spark, "checkpoint"))
    return files.read_batch(spark, root)


PARTS = 8


def balanced_parts(spark, sf_dir):
    """Every row of two tables meets one range condition, and no part is larger than the ranges' bound."""
    tables = (("catalogue", gapped(spark, sf_dir), "id"), ("lineitem", table(spark, sf_dir, "lineitem"), "l_orderkey"))
    out = None
    for name, rows, key in tables:
        keys = rows.select(key)
        conditions = ranges.predicates(keys, key, PARTS)
        sizes = ranges.part_sizes(keys, conditions)
        known, heaviest = keys.where(F.col(key).isNotNull()), keys.where(F.col(key).isNotNull()).groupBy(key).count().agg(F.max("count")).scalar()
        n = known.agg(F.count(F.lit(1))).scalar()
        bound = n / PARTS + heaviest + 2 * n / ranges.ACCURACY
        missing = F.col("part") == len(conditions) - 1
        told = sizes.agg(
            F.sum("n").alias("n_rows"), F.max("meets").alias("most_met"), F.min("meets").alias("least_met"),
            F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("n_missing"), F.count(F.when(~missing, 1)).alias("n_parts"),
            (F.max(F.when(~missing, F.col("n"))) <= bound).alias("balanced"),
        ).select(F.lit(name).alias("name"), "*")
        out = told if out is None else out.unionByName(told)
    return out


# Sinks and codec


def encode_lines(spark, sf_dir):
    return codec.encode_lines(gapped(spark, sf_dir))


def encode_csv_safe(spark, sf_dir):
    return codec.encode_csv_safe(catalogue(spark, sf_dir, RAW))


def csv_round_trip(spark, sf_dir):
    """Raw texts with commas, quotes and line breaks, encoded safely and parsed back."""
    lines = codec.encode_csv_safe(catalogue(spark, sf_dir, RAW))
    return codec.parse_lines(lines, options=codec.SAFE_CSV)


def text_dump(spark, sf_dir):
    """A dump replaces the one before it."""
    path = scratch_path(spark, "dump")
    whole = catalogue(spark, sf_dir)
    publish.text_dump(codec.encode_lines(whole), path)
    publish.text_dump(codec.encode_lines(whole.withColumn("brand", ~F.col("brand"))), path)
    return files.text_lines(spark, path)


def kafka_records(spark, sf_dir):
    return publish.records(codec.encode_lines(gapped(spark, sf_dir)))


def publish_snapshot(spark, sf_dir):
    return publish.snapshot_records(gapped(spark, sf_dir))


def render_rows(spark, sf_dir):
    return codec.decode_nulls(gapped(spark, sf_dir)).select(codec.rendered_row().alias("line"))


def trim_lines(spark, sf_dir):
    """Raw texts between blanks and control characters."""
    padded = F.concat(F.lit(" \t\x01"), "text", F.lit("\r\n \x1f"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), codec.trimmed(padded).alias("value")
    )


def parse_lines(spark, sf_dir):
    lines = publish.snapshot_records(catalogue(spark, sf_dir))
    return codec.parse_lines(lines.select(F.col("value").cast("binary").alias("value")))


def parse_lines_dirty(spark, sf_dir):
    """Descriptions with commas: later fields shift."""
    return codec.parse_lines(codec.encode_lines(catalogue(spark, sf_dir, DIRTY)))


def parse_lines_repaired(spark, sf_dir):
    """Descriptions with commas, read from both ends: the rows as they were."""
    return repair.parse_lines_repaired(codec.encode_lines(catalogue(spark, sf_dir, DIRTY)))


def quarantine_counts(spark, sf_dir):
    """Lines of a dump with line breaks inside records: how many can be read, and why the others cannot."""
    path = scratch_path(spark, "dump")
    publish.text_dump(codec.encode_lines(catalogue(spark, sf_dir, RAW)), path)
    read = repair.read_lines(files.text_lines(spark, path))
    return read.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("value").alias("n_values"))


def rename_columns(spark, sf_dir):
    return codec.to_producer_names(gapped(spark, sf_dir))


def rename_to_consumer(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return codec.to_consumer_names(
        spark.sql(producer_sql(gapped_sql()).replace("FROM documents", "FROM {documents}"), documents=documents)
    )


# Projections


def description_length(spark, sf_dir):
    lengths = features.with_description_length(gapped(spark, sf_dir))
    return lengths.select("id", "eclassnumber", "description_length")


def classify_commands(spark, sf_dir):
    verb = F.element_at(
        F.array(
            F.lit("SELECT * FROM eclasses WHERE description = '"),
            F.lit("Select Count(*) from eclasses where description = '"),
            F.lit("UPDATE eclasses SET description = '"),
            F.lit("DELETE FROM eclasses WHERE description = '"),
        ),
        (F.col("id") % 4 + 1).cast("int"),
    )
    command = F.concat(verb, "description", F.lit("'"))
    return catalogue(spark, sf_dir).select("id", returns_rows(command).alias("returns_rows"))


def feature_columns(spark, sf_dir):
    return features.feature_columns(catalogue(spark, sf_dir))


def result_table_cast(spark, sf_dir):
    errors = _surrogate(spark, sf_dir).withColumn(
        "prediction", (F.col("eclassnumber") - F.col("prediction")) / 7
    )
    return report.result_table(errors)


# Snapshot commands


def _producer(spark, sf_dir):
    return codec.to_producer_names(catalogue(spark, sf_dir))


def sql_select(spark, sf_dir):
    return snapshot.select_rows(
        _producer(spark, sf_dir),
        "SELECT * FROM eclasses WHERE brand AND category LIKE 'de%' OR eclassnumber < 2000000",
    )


def sql_count(spark, sf_dir):
    return snapshot.query(
        _producer(spark, sf_dir),
        "SELECT category, count(*) AS n FROM eclasses WHERE link GROUP BY category",
    )


def snapshot_insert(spark, sf_dir):
    """Suppliers become new rows; columns they lack are NULL."""
    rows = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1_000_000).alias("id"),
        F.col("s_name").alias("description"),
        (F.col("s_acctbal") > 0).alias("brand"),
        F.col("s_nationkey").alias("eclassnumber"),
    )
    return snapshot.insert(catalogue(spark, sf_dir), rows)


def snapshot_update(spark, sf_dir):
    """Two columns swap roles, so each must see the old row; a NULL outcome changes nothing."""
    return snapshot.update(
        gapped(spark, sf_dir),
        {"category": "concat(category, '!')", "taric": "details", "details": "taric"},
        "eclassnumber >= 2000000 AND category IS NOT NULL",
    )


def snapshot_delete(spark, sf_dir):
    return snapshot.delete(gapped(spark, sf_dir), "eclassnumber >= 2000000")


COMMANDS = {
    "insert": """INSERT INTO eclasses (eclassnumber, ID, description, brand)
        SELECT eclassnumber, id + 1000000, upper(category), NOT brand FROM eclasses WHERE link""",
    "update": """UPDATE eclasses AS e SET category = concat(e.category, '!'), taric = e.details, details = e.taric
        WHERE e.eclassnumber >= 2000000 AND category IS NOT NULL""",
    "delete": """DELETE FROM Eclasses WHERE category IN
        (SELECT category FROM eclasses GROUP BY category HAVING count(*) % 2 = 0) OR eclassnumber IS NULL""",
}


def command_insert(spark, sf_dir):
    """An INSERT as text: columns in an order of its own, rows from the snapshot itself."""
    return commands.execute(gapped(spark, sf_dir), COMMANDS["insert"]).snapshot


def command_update(spark, sf_dir):
    """An UPDATE as text: two columns swap roles under an alias."""
    return commands.execute(gapped(spark, sf_dir), COMMANDS["update"]).snapshot


def command_delete(spark, sf_dir):
    """A DELETE as text whose condition asks the snapshot."""
    return commands.execute(gapped(spark, sf_dir), COMMANDS["delete"]).snapshot


def command_session(spark, sf_dir):
    """Commands one after the other; the query at the end sees what they left."""
    prompt = commands.Prompt(gapped(spark, sf_dir))
    prompt.run_all(COMMANDS.values())
    return prompt.run("SELECT category, brand, count(*) AS n, min(id) AS least FROM eclasses GROUP BY category, brand").rows


def _next_snapshot(first: DataFrame) -> DataFrame:
    """Rows go, change and come, and some of them twice."""
    kept = snapshot.update(snapshot.delete(first, "id % 10 = 3"), {"category": "upper(category)"}, "id % 10 = 4")
    doubled = kept.where("id % 10 = 5")
    come = first.where("id % 10 = 6").withColumn("id", (F.col("id") + 1_000_000).cast("int"))
    return kept.unionByName(doubled).unionByName(come)


def snapshot_changes(spark, sf_dir):
    first = gapped(spark, sf_dir)
    return changes.snapshot_changes(first, _next_snapshot(first))


def apply_changes(spark, sf_dir):
    """The first snapshot and the change set give the second."""
    first = gapped(spark, sf_dir)
    return changes.apply_changes(first, changes.snapshot_changes(first, _next_snapshot(first)))


def undo_changes(spark, sf_dir):
    """The second snapshot and the inverse change set give the first."""
    first = gapped(spark, sf_dir)
    second = _next_snapshot(first)
    return changes.apply_changes(second, changes.inverse(changes.snapshot_changes(first, second)))


def change_records(spark, sf_dir):
    """What is published of an update: lines of new rows by key, and keys alone of rows that went."""
    first = catalogue(spark, sf_dir)
    second = snapshot.update(snapshot.delete(first, "id % 10 = 3"), {"category": "upper(category)"}, "id % 10 = 4")
    return publish.change_records(changes.snapshot_changes(first, second))


def stream_merged(spark, sf_dir):
    """Two whole, overlapping snapshots streamed one after the other; each id has its newest row."""
    first = catalogue(spark, sf_dir).where("id % 10 != 6")
    second = snapshot.update(catalogue(spark, sf_dir).where("id % 10 != 3"), {"category": "upper(category)"}, "id % 10 = 4")
    dump, mark = scratch_path(spark, "dump"), scratch_path(spark, "checkpoint")
    target = MergedTable(spark, scratch_path(spark, "merged"), buckets=16)
    for number, whole in enumerate((first, second)):
        publish.text_dump(publish.snapshot_records(whole), f"{dump}/{number}")
        merge_available(files.text_stream(spark, f"{dump}/*", files_per_batch=3), target, mark)
    return target.rows().drop("timestamp")


def stream_changes_merged(spark, sf_dir):
    """A snapshot and then its change set, as keyed records that may delete, merged in two batches."""
    first = catalogue(spark, sf_dir)
    second = snapshot.update(snapshot.delete(first, "id % 10 = 3"), {"category": "upper(category)"}, "id % 10 = 4")
    whole = publish.snapshot_records(first).withColumn("key", F.get(F.split("value", ",", 2), F.lit(0)))
    batches = whole, publish.change_records(changes.snapshot_changes(first, second))
    inbox, mark = scratch_path(spark, "inbox"), scratch_path(spark, "checkpoint")
    target = MergedTable(spark, scratch_path(spark, "merged"), deleted="deleted", buckets=16)
    for number, records in enumerate(batches):
        stamped = records.select("key", "value", F.timestamp_seconds(F.lit(1_700_000_000 + number)).alias("timestamp"))
        stamped.write.parquet(f"{inbox}/{number}")
        stream = spark.readStream.schema(stamped.schema).parquet(f"{inbox}/*")
        merge_available(stream, target, mark)
    return target.rows().drop("timestamp")


def compacted_batches(spark, sf_dir):
    """Micro-batches streamed, compacted in two steps, and a later one; the reader gives all rows once, by day."""
    dump, root, mark = (scratch_path(spark, label) for label in ("dump", "batches", "checkpoint"))
    whole = catalogue(spark, sf_dir)
    whole_table = BatchTable(spark, root)
    for part in range(3):
        publish.text_dump(publish.snapshot_records(whole.where(F.col("id") % 3 == part)), f"{dump}/{part}")
        ingest_available(files.text_stream(spark, f"{dump}/*", files_per_batch=2), root, mark)
        if part < 2:
            whole_table.compact()
    whole_table.merge_parts()
    whole_table.vacuum()
    return whole_table.rows().drop("timestamp")


def latest_whole_snapshot(spark, sf_dir):
    """Two overlapping snapshots stored together; only the newer one's rows come back."""
    first = catalogue(spark, sf_dir)
    second = snapshot.update(snapshot.delete(first, "link"), {"category": "upper(category)"})
    path = scratch_path(spark, "snapshots")
    stored = snapshot.versioned(first, 1).unionByName(snapshot.versioned(second, 2))
    stored.write.partitionBy("snapshot_id").parquet(path)
    return snapshot.latest_snapshot(spark.read.parquet(path)).drop("snapshot_id")


def latest_rows_gapped(spark, sf_dir):
    """The newest row of each known id, and every row without one; the copies differ, so an older one would show."""
    both = _twice(gapped(spark, sf_dir)).withColumn("category", F.concat("category", F.lit(" v"), F.col("version")))
    return snapshot.latest_rows(both, "id", "version")


def _twice(frame: DataFrame) -> DataFrame:
    return frame.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))


def latest_snapshot(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return snapshot.latest_rows(events, "user_id", "ts", "event_id").drop("ts")


# Text


def tokenize(spark, sf_dir):
    return _token_rows(spark, sf_dir, text.tokens(F.col("description")))


def remove_stop_words(spark, sf_dir):
    return _token_rows(
        spark, sf_dir, text.without_stop_words(text.tokens(F.col("description")))
    )


def ngrams5(spark, sf_dir):
    return terms.term_rows(_description_terms(spark, sf_dir), "id", "terms")


def term_counts(spark, sf_dir):
    return terms.term_counts(_description_words(spark, sf_dir), "id", "words", n=TERM_WORDS)


def vocabulary_topk(spark, sf_dir):
    return terms.vocabulary(terms.term_stats(_description_words(spark, sf_dir), "words", TERM_WORDS))


def vocabulary_by_names(spark, sf_dir):
    """The same terms without a shuffle of all terms' texts."""
    return topk.top_terms(_description_words(spark, sf_dir), "words", n=TERM_WORDS)


def doc_freq(spark, sf_dir):
    return terms.doc_freq(_description_words(spark, sf_dir), "words", TERM_WORDS)


def tfidf(spark, sf_dir):
    return _rounded(terms.tfidf(_description_words(spark, sf_dir), "id", "words", n=TERM_WORDS), "tfidf")


def tfidf_limited(spark, sf_dir):
    """TF-IDF of the words of descriptions with all three limits: on rows, inside a row, and on weights."""
    words = text.catalogue_terms(F.col("description"), 1)
    rows = catalogue(spark, sf_dir).select("id", words.alias("terms"))
    return _rounded(terms.tfidf(rows, "id", "terms", min_df=0.01, min_tf=2, min_doc_freq=40), "tfidf")


def tfidf_vocabulary(spark, sf_dir):
    """TF-IDF of the vocabulary's terms only, as the vectors hold it."""
    weighted = terms.tfidf(
        _description_words(spark, sf_dir), "id", "words", terms.VOCABULARY_SIZE, n=TERM_WORDS
    )
    return _rounded(weighted, "tfidf")


def tokenize_category(spark, sf_dir):
    return _token_rows(spark, sf_dir, text.tokens(F.col("category")))


def category_stop(spark, sf_dir):
    return _token_rows(spark, sf_dir, text.without_stop_words(text.tokens(F.col("category"))))


def category_counts(spark, sf_dir):
    return terms.term_counts(_category_terms(spark, sf_dir), "id", "terms")


def category_tfidf(spark, sf_dir):
    weighted = terms.tfidf(
        _category_terms(spark, sf_dir), "id", "terms", terms.VOCABULARY_SIZE
    )
    return _rounded(weighted, "tfidf")


def feature_vectors(spark, sf_dir):
    """Every non-zero slot of every vector, terms by bucket."""
    return _named_slots(spark, sf_dir, None)


def feature_vectors_topk(spark, sf_dir):
    """The same with slots of their own for the most frequent terms, and none for the others."""
    return _named_slots(spark, sf_dir, 262_144)


def feature_vectors_weighted(spark, sf_dir):
    """The same with buckets that add up their terms' own weights, read from the vectors."""
    whole = catalogue(spark, sf_dir)
    slots = features.vector_slots(weighted.weighted_vectors(whole))
    return _rounded(slots.join(F.broadcast(_slot_parts(spark)), "slot").drop("slot"), "value")


def _slot_parts(spark):
    """What each slot of a weighted vector holds, in the order of the vector."""
    widths = {"description": 1 << 17, "category": 1 << 12}
    parts = [("id", 1), ("description_length", 1), *widths.items(), *((name, 1) for name in features.FLAGS)]
    names = [(part, str(i) if part in widths else None) for part, width in parts for i in range(width)]
    frame = pd.DataFrame(names, columns=["part", "term"])
    frame.insert(0, "slot", range(len(frame)))
    return spark.createDataFrame(frame, "slot int, part string, term string")


def _named_slots(spark, sf_dir, vocabulary_size):
    whole = catalogue(spark, sf_dir)
    model = features.fit_features(whole, vocabulary_size)
    slots = features.vector_slots(features.feature_vectors(whole, model))
    named = slots.join(F.broadcast(features.slot_names(spark, model)), "slot")
    return _rounded(named.drop("slot"), "value")


# Split, model, errors


def random_split(spark, sf_dir):
    """Each row falls in exactly one part."""
    train, test = split.random_split(catalogue(spark, sf_dir).select("id", "eclassnumber"))
    return train.unionAll(test).groupBy("id", "eclassnumber").agg(F.count(F.lit(1)).alias("n"))


def random_split_share(spark, sf_dir):
    """Whether the train part is 70% of all rows, within four deviations."""
    train, test = split.random_split(catalogue(spark, sf_dir).select("id"))
    parts = train.select(F.lit(1).alias("train")).unionAll(test.select(F.lit(0)))
    share, rows = F.avg("train"), F.count("train")
    near = F.abs(share - 0.7) <= 4 * F.sqrt(F.lit(0.7 * 0.3) / rows)
    return parts.agg(near.alias("about_seventy_percent"))


def hash_split(spark, sf_dir):
    return split.with_split(catalogue(spark, sf_dir).select("id")).select("id", "split")


def hash_split_gapped(spark, sf_dir):
    """Rows without id belong to neither part."""
    rows = split.with_split(gapped(spark, sf_dir).select("id"))
    return rows.groupBy("split", "fold").agg(F.count(F.lit(1)).alias("n"))


def exact_split(spark, sf_dir):
    """Seven tenths of the ids, to the very number; copies of an id stay together."""
    return exact.exact_split(_twice(gapped(spark, sf_dir)).select("id", "version")).groupBy("id", "split").agg(F.count(F.lit(1)).alias("n"))


def cv_fold_sizes(spark, sf_dir):
    folds = split.with_split(catalogue(spark, sf_dir).select("id")).where("split = 'train'")
    return folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


def _line_fit(frame: DataFrame, estimator: LinearRegression, places: int) -> DataFrame:
    """Fit one feature `x` to the label and return the line."""
    assembled = VectorAssembler(inputCols=["x"], outputCol="features").transform(frame)
    model = estimator.fit(assembled.select("eclassnumber", "features"))
    line = [(float(model.coefficients[0]), float(model.intercept))]
    return _rounded(
        frame.sparkSession.createDataFrame(line, "slope double, intercept double"),
        "slope",
        "intercept",
        places=places,
    )


def linreg_ols_1d(spark, sf_dir):
    frame = table(spark, sf_dir, "lineitem").selectExpr(
        "l_quantity AS x", "l_extendedprice AS eclassnumber"
    )
    return _line_fit(frame, training.regression(0.0), 6)


def linreg_enet_1d(spark, sf_dir):
    frame = table(spark, sf_dir, "lineitem").selectExpr(
        "l_quantity AS x", "l_extendedprice * l_quantity AS eclassnumber"
    )
    return _line_fit(frame, training.regression(5000.0), 4)


def _line_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with one feature, for which fits have a closed form."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS id",
        "l_quantity AS x",
        "l_extendedprice AS eclassnumber",
    )
    assembled = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    return materialize(split.with_split(assembled.drop("x")), "line", ("split", "fold"))


# Fits at once over these small tables.
SMALL_FITS = 4
LINE_PENALTIES = (0.0, 1000.0, 5000.0)


def cv_metrics_line(spark, sf_dir):
    """RMSE of every penalty over the folds, with one feature."""
    train = _line_table(spark, sf_dir).where("split = 'train'")
    rows = sorted(training.tune(train, LINE_PENALTIES).averages.items())
    frame = spark.createDataFrame(rows, "penalty double, rmse double")
    return _rounded(frame, "rmse", places=4)


def predictions_line(spark, sf_dir):
    """Test rows scored by the model that tuning picks, with one feature."""
    rows = _line_table(spark, sf_dir)
    tuned = training.tune(rows.where("split = 'train'"), LINE_PENALTIES, parallelism=SMALL_FITS)
    scored = tuned.model.transform(rows.where("split = 'test'"))
    return _rounded(scored.select("id", "eclassnumber", "prediction"), "prediction", places=4)


def _feature_table(spark, sf_dir):
    whole = catalogue(spark, sf_dir)
    return flow.feature_table(whole, features.fit_features(whole))


def _scalar_rows(spark, sf_dir):
    """The scalar slots with label, split and fold: a narrow plan, read once by each query."""
    wide = features.with_description_length(features.without_gaps(catalogue(spark, sf_dir)))
    slots = {name: F.col(name).cast("double") for name in features.SCALARS if name != "id"}
    return split.with_split(wide).withColumns(slots).withColumn("id_slot", F.col("id").cast("double"))


SCALAR_SLOTS = ["id_slot", *features.SCALARS[1:]]
SCALAR_PENALTIES = (0.0, 1000.0, 100_000.0)


def linreg_scalars(spark, sf_dir):
    """Coefficients of the scalar slots on the train rows, for every penalty."""
    train = _scalar_rows(spark, sf_dir).where("split = 'train'")
    whole = sum(moments.fold_moments(train, SCALAR_SLOTS).values(), moments.Moments.none(len(SCALAR_SLOTS) + 1))
    rows = []
    for penalty in SCALAR_PENALTIES:
        line = moments.fit(whole, SCALAR_SLOTS, penalty)
        rows += [(penalty, name, float(w)) for name, w in zip(SCALAR_SLOTS, line.coefficients)] + [(penalty, "intercept", line.intercept)]
    return _rounded(spark.createDataFrame(rows, "penalty double, slot string, weight double"), "weight", places=3)


def cv_errors_scalars(spark, sf_dir):
    """RMSE of every penalty on every fold left out, from one aggregation."""
    tuned = moments.tune(_scalar_rows(spark, sf_dir).where("split = 'train'"), SCALAR_SLOTS, SCALAR_PENALTIES)
    rows = [(penalty, fold, error) for penalty, by in tuned.errors.items() for fold, error in by.items()]
    return _rounded(spark.createDataFrame(rows, "penalty double, fold int, rmse double"), "rmse", places=3)


def predictions_scalars(spark, sf_dir):
    """Test rows scored by the plane that tuning over the scalar slots picks."""
    rows = _scalar_rows(spark, sf_dir)
    tuned = moments.tune(rows.where("split = 'train'"), SCALAR_SLOTS, SCALAR_PENALTIES)
    scored = rows.where("split = 'test'").withColumn("prediction", tuned.line.prediction())
    return _rounded(scored.select("id", "eclassnumber", "prediction"), "prediction", places=3)


def metrics_scalars(spark, sf_dir):
    """The errors of that plane on the test rows."""
    errors = metrics.regression_metrics(predictions_scalars(spark, sf_dir))
    return _rounded(errors, "mae", "mse", "rmse", "r2", places=2)


def linreg_fit(spark, sf_dir):
    """One wide fit, scored twice: by the model, and from its coefficients joined to the slots of each row."""
    vectors = _feature_table(spark, sf_dir)
    model = training.regression(training.PENALTIES[1]).fit(vectors.where("split = 'train'"))
    weights = pd.DataFrame({"weight": model.coefficients.toArray()}).rename_axis("slot").reset_index()
    weights = spark.createDataFrame(weights[weights["weight"] != 0], "slot int, weight double")
    sums = (
        features.vector_slots(vectors).join(F.broadcast(weights), "slot").groupBy("id")
        .agg(F.sum(F.col("value") * F.col("weight")).alias("dot"))
    )
    scored = model.transform(vectors).join(sums, "id", "left")
    again = F.coalesce("dot", F.lit(0.0)) + F.lit(float(model.intercept))
    # without the sign of a negative zero, and relative to labels of millions
    difference = F.abs(F.round((F.col("prediction") - again) / 1000, 6)).alias("difference")
    return scored.select("id", "split", "eclassnumber", difference)


def cv_metrics(spark, sf_dir):
    """RMSE of every penalty, averaged over the folds."""
    vectors = _feature_table(spark, sf_dir)
    tuned = training.tune(vectors.where("split = 'train'"), parallelism=SMALL_FITS)
    rows = sorted(tuned.averages.items())
    return spark.createDataFrame(rows, "penalty double, rmse double")


def predictions(spark, sf_dir):
    """The whole job: the sorted actual-versus-predicted table of the test rows."""
    return flow.run(catalogue(spark, sf_dir), parallelism=SMALL_FITS).result


def regression_metrics(spark, sf_dir):
    errors = metrics.regression_metrics(_surrogate(spark, sf_dir))
    return _rounded(errors, "mae", "mse", "rmse", "r2", places=4)


def metrics_of_predictions(spark, sf_dir):
    """Errors of a tuned model on its own test rows."""
    errors = metrics.regression_metrics(predictions_line(spark, sf_dir))
    return _rounded(errors, "mae", "mse", "rmse", "r2", places=4)


def report_of_predictions(spark, sf_dir):
    """The first hundred rows of the sorted actual-versus-predicted table of that model."""
    return report.top_rows(report.result_table(predictions_line(spark, sf_dir)))


def regression_metrics_gapped(spark, sf_dir):
    """Errors with rows that lack a label; how many is part of the result."""
    rows = gapped(spark, sf_dir).withColumn("prediction", F.length("description") * 1000)
    return _rounded(metrics.regression_metrics(rows), "mae", "mse", "rmse", "r2", places=4)


def regression_metrics_by(spark, sf_dir):
    errors = metrics.regression_metrics(_surrogate(spark, sf_dir), by=("l_returnflag",))
    return _rounded(errors, "mae", "mse", "rmse", "r2", places=4)


def describe_label(spark, sf_dir):
    return _rounded(describe.describe(catalogue(spark, sf_dir), "eclassnumber"), "mean", "stddev")


def describe_by_split(spark, sf_dir):
    labelled = split.with_split(catalogue(spark, sf_dir).select("id", "eclassnumber"))
    return _rounded(describe.describe_by(labelled, "eclassnumber", "split"), "mean", "stddev")


# Reports


def result_sorted(spark, sf_dir):
    return report.sorted_by_actual(report.result_table(_surrogate(spark, sf_dir)))


def result_top100(spark, sf_dir):
    return report.top_rows(report.result_table(_surrogate(spark, sf_dir)))


def chart_series(spark, sf_dir):
    whole = _surrogate(spark, sf_dir).withColumn("eclassnumber", F.floor("eclassnumber").cast("int"))
    return report.chart_series(report.result_table(whole))


def chart_bins(spark, sf_dir):
    return report.chart_bins(report.result_table(_surrogate(spark, sf_dir)), 5000)


def chart_quantile_bins(spark, sf_dir):
    """How many rows the data-driven cells hold, that none holds more than its share and ties, and that none overlap."""
    points = report.result_table(_surrogate(spark, sf_dir))
    cells = density.quantile_bins(points, 8, 8)
    n = F.sum("n")
    tied = points.groupBy("prediction").count().agg(F.max("count")).scalar()
    return cells.agg(
        n.alias("n"), (F.max("n") <= n / 64 + tied).alias("within_share"), F.countDistinct("strip").alias("strips"),
        F.max("actual_max").alias("greatest"), F.min("prediction_min").alias("least"),
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        full_scan,
        decode_nulls,
        text_lines,
        parquet_schema_scan,
        read_batch,
        stream_ingest,
        encode_lines,
        encode_csv_safe,
        csv_round_trip,
        text_dump,
        kafka_records,
        publish_snapshot,
        render_rows,
        trim_lines,
        parse_lines,
        parse_lines_dirty,
        parse_lines_repaired,
        quarantine_counts,
        rename_columns,
        rename_to_consumer,
        description_length,
        classify_commands,
        feature_columns,
        result_table_cast,
        sql_select,
        sql_count,
        snapshot_insert,
        snapshot_update,
        snapshot_delete,
        command_insert,
        command_update,
        command_delete,
        command_session,
        snapshot_changes,
        apply_changes,
        undo_changes,
        change_records,
        stream_merged,
        stream_changes_merged,
        compacted_batches,
        latest_rows_gapped,
        latest_snapshot,
        latest_whole_snapshot,
        tokenize,
        remove_stop_words,
        ngrams5,
        term_counts,
        vocabulary_topk,
        vocabulary_by_names,
        doc_freq,
        tfidf,
        tfidf_limited,
        tfidf_vocabulary,
        tokenize_category,
        category_stop,
        category_counts,
        category_tfidf,
        random_split,
        random_split_share,
        hash_split,
        hash_split_gapped,
        exact_split,
        cv_fold_sizes,
        linreg_ols_1d,
        linreg_enet_1d,
        cv_metrics_line,
        predictions_line,
        regression_metrics,
        regression_metrics_by,
        regression_metrics_gapped,
        metrics_of_predictions,
        report_of_predictions,
        describe_label,
        describe_by_split,
        result_sorted,
        result_top100,
        chart_series,
        chart_bins,
        chart_quantile_bins,
        balanced_parts,
        linreg_scalars,
        cv_errors_scalars,
        predictions_scalars,
        metrics_scalars,
        # The wide vectors last: they need the most memory.
        feature_vectors,
        feature_vectors_topk,
        feature_vectors_weighted,
        linreg_fit,
        cv_metrics,
        predictions,
    )
}
