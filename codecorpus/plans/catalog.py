"""Every operator as a named query over the given tables.

Texts come from ``documents``; function code is derived row by row from
``orders``. Each query reads its whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from codecorpus.functions import udf
from codecorpus.functions.draws import digest, draw
from codecorpus.functions.text import (
    append_mask,
    code_tokens,
    confidence,
    default_end_line,
    local_repo_name,
    newline_count,
    nonblank_lines,
    relative_path,
    repo_from_path,
    same_stripped,
    signature,
    to_numeric,
)
from codecorpus.operators import (
    beam,
    bpe,
    caps,
    clean,
    extract,
    masking,
    model,
    repos,
    scoring,
    splits,
    summary,
    training_log,
    validate,
)
from codecorpus.plans import collect, datasets, evaluate
from codecorpus.session import Staging, spread
from codecorpus.sources import readers, writers

SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def key_text() -> Column:
    return F.col("o_orderkey").cast("string")


def function_code() -> Column:
    """A nine-line function per order: two statements that can be hidden, one ``elif``."""
    price = F.floor("o_totalprice").cast("bigint").cast("string")
    return F.concat(
        F.lit("def check_"), key_text(), F.lit("(x):\n    y = x\n    if x > "), price,
        F.lit(":\n        y = 1\n    elif x < 0:\n        y = 2\n    if y == "),
        (F.col("o_custkey") % 7).cast("string"), F.lit(':\n        return "'), F.col("o_orderstatus"),
        F.lit('"\n    return y'),
    )


def code(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", function_code().alias("original_code"))


def mixed_code(spark, sf_dir) -> DataFrame:
    """A third of the customers' orders give code without any statement."""
    plain = F.concat(F.lit("x = "), key_text(), F.lit("\ny = 'if'"))
    text = F.when(F.col("o_custkey") % 3 == 0, plain).otherwise(function_code())
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("code"))


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents")


def document_functions(spark, sf_dir) -> DataFrame:
    """Documents in the form of extracted functions; some have no start line."""
    start = F.when(F.col("n_chars") % 97 != 0, F.lit(1))
    return documents(spark, sf_dir).select(
        F.col("source").alias("path"), F.col("doc_id").alias("seq"), F.col("text").alias("original_code"), "lang",
        "n_chars", start.alias("start_line"), (newline_count(F.col("text")) + 1).alias("end_line"),
    )


def source_files(spark, sf_dir) -> DataFrame:
    """One file per order: a function and an async one; status P breaks the syntax."""
    broken = F.when(F.col("o_orderstatus") == "P", "def (:\n").otherwise("")
    body = F.concat(
        broken, function_code(), F.lit("\n\nclass Box:\n    @staticmethod\n    async def ping_"), key_text(),
        F.lit("(z):\n        return z\n"),
    )
    path = F.concat(F.col("o_orderpriority"), F.lit("/src/f"), key_text(), F.lit(".py"))
    return table(spark, sf_dir, "orders").select(path.alias("path"), F.encode(body, "UTF-8").alias("content"))


# --- text, cleaning, dedup, caps --------------------------------------------------


def q_nonblank_lines(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", nonblank_lines(F.col("text")).cast("bigint").alias("lines"))


def q_code_tokens(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", code_tokens(F.col("text")).alias("tokens"))


def q_clean_reject_reason(spark, sf_dir):
    return clean.with_reject_reason(document_functions(spark, sf_dir)).select("seq", "reject_reason")


def _counters(spark, sf_dir):
    return collect.collection_counters(
        extract.file_status(source_files(spark, sf_dir)), document_functions(spark, sf_dir)
    )


def q_collection_counters(spark, sf_dir):
    return _counters(spark, sf_dir)


def q_description_report(spark, sf_dir):
    return collect.description(_counters(spark, sf_dir))


def q_dedup_exact(spark, sf_dir):
    return clean.dedup_exact(document_functions(spark, sf_dir)).select("path", "seq", "n_chars")


def q_append_new_anti(spark, sf_dir):
    docs = document_functions(spark, sf_dir)
    return clean.append_new(docs.filter("lang = 'en'"), docs).select("path", "seq")


def q_cap_after_clean(spark, sf_dir):
    prefix = clean.cap_after_clean(document_functions(spark, sf_dir), n=100)
    return clean.with_reject_reason(prefix).select("path", "seq", "reject_reason")


def q_head_cap(spark, sf_dir):
    return caps.head(documents(spark, sf_dir), 150, ["doc_id"]).select("doc_id", "n_chars")


def q_first_matching(spark, sf_dir):
    rows = mixed_code(spark, sf_dir)
    return caps.first_matching(rows, masking.has_statement(F.col("code")), 1000, ["o_orderkey"]).select("o_orderkey", "code")


# --- repositories and paths -------------------------------------------------------


def q_repo_urls(spark, sf_dir):
    return repos.repo_urls(documents(spark, sf_dir), "source")


def q_repo_name_first_wins(spark, sf_dir):
    return repos.dedup_repo_names(table(spark, sf_dir, "pages").select(F.col("page_id").alias("line_no"), "url"))


def q_path_parts(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        repo_from_path(url).alias("repo"),
        relative_path(url).alias("rest"),
        local_repo_name(url).alias("local_name"),
    )


def _named_files(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    from_pages = pages.select(F.concat(F.lit("p"), "page_id").alias("id"), F.element_at(F.split("url", "/", -1), 5).alias("repo_name"))
    return from_pages.unionByName(
        documents(spark, sf_dir).select(F.concat(F.lit("d"), "doc_id").alias("id"), F.col("source").alias("repo_name"))
    )


def _url_lines(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("line_no"), F.col("url").alias("line"))


def q_repo_url_lookup(spark, sf_dir):
    return repos.attach_repo_url(_named_files(spark, sf_dir), _url_lines(spark, sf_dir))


def q_repo_url_exact(spark, sf_dir):
    return repos.attach_repo_url(_named_files(spark, sf_dir), _url_lines(spark, sf_dir), exact=True)


# --- extraction -------------------------------------------------------------------


def q_signature_end_line(spark, sf_dir):
    text = function_code()
    end = F.when(F.col("o_orderstatus") != "P", F.lit(9).cast("int"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        signature(F.concat(F.lit("check_"), key_text()), F.col("o_orderstatus") == "F").alias("signature"),
        default_end_line(F.lit(1), end, text).cast("bigint").alias("end_line"),
    )


def q_extract_functions(spark, sf_dir):
    rows = extract.function_columns(extract.extract_functions(source_files(spark, sf_dir)))
    return rows.drop("path", "code_tokens")


def q_file_status(spark, sf_dir):
    return extract.file_status(source_files(spark, sf_dir))


# --- masking and splits -----------------------------------------------------------


def q_find_statements(spark, sf_dir):
    return masking.statement_table(code(spark, sf_dir)).select(
        "o_orderkey", "statement", F.col("line_index").cast("bigint").alias("line_index")
    )


def q_mask_drop(spark, sf_dir):
    rows = masking.mask_statement(mixed_code(spark, sf_dir), "o_orderkey", "code", SEED)
    return rows.select("o_orderkey", "input_text", "target_text")


def q_mask_keep(spark, sf_dir):
    rows = masking.mask_statement(mixed_code(spark, sf_dir), "o_orderkey", "code", SEED, on_missing="keep")
    return rows.select("o_orderkey", "input_text", "target_text", "has_if")


def q_skipped_no_match(spark, sf_dir):
    return masking.skipped_no_match(mixed_code(spark, sf_dir), "code")


def q_split_exact(spark, sf_dir):
    return splits.split_dataset(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", SEED)


def q_split_sizes(spark, sf_dir):
    return splits.split_sizes(q_split_exact(spark, sf_dir))


def q_split_hashed(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey")
    return splits.split_dataset(rows, "o_orderkey", SEED, exact=False)


def document_ids(spark, sf_dir) -> DataFrame:
    """Documents as id lists: an id per distinct word, short words as special ids."""
    words = F.split("text", "[ \n]+", -1)
    ids = F.transform(
        words,
        lambda w: F.when(F.length(w) < 2, F.length(w)).otherwise(6 + F.pmod(draw(F.md5(w)), F.lit(994))).cast("int"),
    )
    return documents(spark, sf_dir).select("doc_id", ids.alias("input_ids"))


def q_mask_tokens(spark, sf_dir):
    rows = masking.mask_tokens(document_ids(spark, sf_dir), "doc_id", vocab_size=1000, seed=SEED)
    return rows.select("doc_id", F.array_join("input_ids", ",").alias("ids"), F.array_join("labels", ",").alias("labels"))


def pretrain_text_rows(spark, sf_dir) -> DataFrame:
    """Id lists as text, of length 8 where good; the customer number picks the fault."""
    kind = F.col("o_custkey") % 7
    k = key_text()
    good = F.concat(F.lit("["), k, F.lit(", 2, 3, 4, 5, 6, 7, 8]"))
    ids = F.when(kind == 1, F.concat(F.lit("[1, "), k)).when(kind == 2, F.lit("x")).when(kind == 3, F.lit("[1, 2]")).otherwise(good)
    none = F.lit("[-100, -100, -100, -100, -100, -100, -100, -100]")
    labels = F.when(kind.isin(3, 4), none).when(kind == 5, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("[-100, -100, "), k, F.lit(", -100, -100, -100, -100, -100]"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", ids.alias("input_ids"), labels.alias("labels"), function_code().alias("original_code_snippet")
    )


def q_validate_pretrain(spark, sf_dir):
    return validate.validate_pretrain(pretrain_text_rows(spark, sf_dir), seq_len=8)


def q_error_examples(spark, sf_dir):
    checked = validate.check_pretrain(pretrain_text_rows(spark, sf_dir), seq_len=8)
    return validate.error_examples(checked, "o_orderkey").select(
        "row_number", "o_orderkey", F.array_join("errors", ",").alias("errors")
    )


# --- subwords ---------------------------------------------------------------------


def q_word_frequencies(spark, sf_dir):
    return bpe.word_frequencies(documents(spark, sf_dir))


def q_pair_counts(spark, sf_dir):
    words = (
        documents(spark, sf_dir).select(F.explode(F.split("text", "[ \n]+", -1)).alias("word"))
        .groupBy("word").agg(F.count("*").alias("n"))
    )
    return bpe.pair_counts(words.select(F.split("word", "", -1).alias("symbols"), "n"))


def _document_vocabulary(spark, sf_dir) -> bpe.Vocabulary:
    return bpe.learn_merges(documents(spark, sf_dir), vocab_size=512)


def q_learn_merges(spark, sf_dir):
    return _document_vocabulary(spark, sf_dir).merges_df(spark)


def q_build_vocabulary(spark, sf_dir):
    return bpe.build_vocabulary(_document_vocabulary(spark, sf_dir), spark)


def q_encode_decode(spark, sf_dir):
    vocab = _document_vocabulary(spark, sf_dir)
    rows = bpe.encode(documents(spark, sf_dir), vocab, max_len=None)
    return bpe.decode(rows, vocab).select("doc_id", "decoded")


def _code_vocabulary(spark, sf_dir) -> bpe.Vocabulary:
    return bpe.learn_merges(code(spark, sf_dir), "original_code", vocab_size=160)


def _masked_code(spark, sf_dir) -> DataFrame:
    return masking.mask_statement(code(spark, sf_dir), "o_orderkey", seed=SEED)


def q_prepare_pairs(spark, sf_dir):
    vocab = _code_vocabulary(spark, sf_dir)
    rows = bpe.prepare_pairs(_masked_code(spark, sf_dir), vocab)
    rows = bpe.decode(bpe.decode(rows, vocab, "labels", "_t"), vocab, "input_ids", "_i")
    return rows.select(
        "o_orderkey",
        F.size("input_ids").cast("bigint").alias("input_len"),
        F.size("labels").cast("bigint").alias("label_len"),
        (F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x) > 10).alias("masked"),
        F.regexp_replace("_i", "(<pad>)+$", "").alias("input_decoded"),
        F.regexp_replace("_t", "(<pad>)+$", "").alias("target_decoded"),
    )


def q_validate_tokenizer(spark, sf_dir):
    rows = _masked_code(spark, sf_dir)
    return bpe.validate_tokenizer(rows, _code_vocabulary(spark, sf_dir), "input_text")


def q_pretrain_table(spark, sf_dir):
    """Labels put back into the masked ids, then decoded: the code of every row."""
    vocab = _code_vocabulary(spark, sf_dir)
    rows = datasets.pretrain_table(code(spark, sf_dir), vocab, "o_orderkey")
    whole = F.zip_with("input_ids", "labels", lambda i, x: F.when(x == -100, i).otherwise(x))
    rows = bpe.decode(rows.withColumn("_ids", bpe.without_pads(whole)), vocab, "_ids", "restored")
    return rows.select(
        "o_orderkey", F.size("input_ids").cast("bigint").alias("ids"), F.size("labels").cast("bigint").alias("labels"),
        "original_code_snippet", "restored",
    )


# --- prediction and scoring ---------------------------------------------------------


def q_append_mask(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", append_mask(F.col("text")).alias("text"))


def q_confidence(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(confidence(-F.col("value") / 10), 4).alias("confidence"))


def _finetune(spark, sf_dir) -> DataFrame:
    return datasets.finetune_table(code(spark, sf_dir), "o_orderkey")


def q_finetune_table(spark, sf_dir):
    return _finetune(spark, sf_dir)


def _train_test(spark, sf_dir):
    masked = splits.split_dataset(_masked_code(spark, sf_dir), "o_orderkey", SEED, exact=False)
    rows = Staging(spark).put(masked.select("o_orderkey", "input_text", "target_text", "split"), "pairs")
    return rows.filter("split = 'train'"), rows.filter("split = 'test'")


def q_statement_model(spark, sf_dir):
    return model.fit_statement_model(_masked_code(spark, sf_dir))


def q_predict_topk(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    predicted = model.predict_statements(model.fit_statement_model(train), test, k=5)
    return model.candidate_rows(predicted).select("o_orderkey", "level", "rank", "predicted_if", "n")


def q_beam_search(spark, sf_dir):
    """Ten beams over the token model for every test row; ``is_correct``: the tokens equal the target's."""
    train, test = _train_test(spark, sf_dir)
    found = beam.beam_search(beam.fit_next_tokens(train), test, "o_orderkey")
    want = test.select("o_orderkey", model.target_tokens(F.col("target_text")).alias("want"))
    return found.join(want, "o_orderkey").select(
        "o_orderkey", "rank", "predicted_if", F.round("score", 6).alias("score"),
        (F.filter("tokens", lambda t: t != beam.END) == F.col("want")).alias("is_correct"),
    )


def q_beam_accuracy(spark, sf_dir):
    """Share of test rows whose first beam, or whose first count-based candidate, has the target's tokens."""
    train, test = _train_test(spark, sf_dir)
    first = beam.beam_search(beam.fit_next_tokens(train), test, "o_orderkey").filter("rank = 1")
    counted = model.best_prediction(model.predict_statements(model.fit_statement_model(train), test))
    want = test.select("o_orderkey", model.target_tokens(F.col("target_text")).alias("want"))
    beams = first.join(want, "o_orderkey").select((F.filter("tokens", lambda t: t != beam.END) == F.col("want")).cast("int").alias("ok"))
    counts = counted.select((model.target_tokens(F.col("predicted_if")) == model.target_tokens(F.col("target_text"))).cast("int").alias("ok"))
    return beams.agg(F.count("*").alias("rows"), F.round(F.avg("ok"), 4).alias("beam_accuracy")).crossJoin(
        counts.agg(F.round(F.avg("ok"), 4).alias("topk_accuracy"))
    )


def q_token_perplexity(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    scored = model.attach_perplexity(model.fit_token_counts(train), test)
    return scored.select("o_orderkey", F.round("perplexity", 4).alias("perplexity"))


def _predictions(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return train, test, model.best_prediction(model.predict_statements(model.fit_statement_model(train), test))


def q_exact_match_accuracy(spark, sf_dir):
    _, _, predicted = _predictions(spark, sf_dir)
    correct = same_stripped(F.col("predicted_if"), F.col("target_text"))
    return predicted.select(correct.alias("is_correct")).agg(
        F.count("*").alias("rows"), F.round(scoring.accuracy(), 4).alias("accuracy")
    )


def q_similarity(spark, sf_dir):
    _, _, predicted = _predictions(spark, sf_dir)
    return scoring.score_rows(predicted).select("o_orderkey", "prediction_score", "is_correct")


def q_evaluation_metrics(spark, sf_dir):
    train, test, predicted = _predictions(spark, sf_dir)
    return evaluate.evaluation_metrics(test, predicted, model.fit_token_counts(train), "o_orderkey")


def q_benchmark(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return evaluate.benchmark(
        mixed_code(spark, sf_dir), model.fit_statement_model(train), model.fit_token_counts(train), "o_orderkey"
    )


def q_evaluation_totals(spark, sf_dir):
    """The part of the totals that SQL can compute; similarity is pruned away."""
    totals = q_evaluation_metrics(spark, sf_dir)
    return totals.select("rows", F.round("accuracy", 4).alias("accuracy"), F.round("mean_perplexity", 4).alias("mean_perplexity"))


def q_benchmark_predictions(spark, sf_dir):
    """The benchmark without its similarity column."""
    rows = q_benchmark(spark, sf_dir)
    return rows.drop("prediction_score").withColumn("perplexity", F.round("perplexity", 4))


def first_word_predictor():
    """A stand-in for a model: the first word of the text, scored by its length."""
    return lambda texts: [(t.split(" ", 1)[0], -float(len(t.split(" ", 1)[0]))) for t in texts]


def q_score_batches(spark, sf_dir):
    return scoring.score_batches(documents(spark, sf_dir), first_word_predictor, "doc_id", "text")


def q_generated_set(spark, sf_dir):
    rows = evaluate.generated_set(documents(spark, sf_dir).withColumnRenamed("text", "code"), first_word_predictor, "doc_id")
    return rows.select("doc_id", "predicted_if", F.round("confidence", 4).alias("confidence"))


def count_words(frame):
    return frame[["doc_id"]].assign(words=frame["text"].str.count(" ") + 1)


def q_map_batches(spark, sf_dir):
    return udf.map_batches(documents(spark, sf_dir).select("doc_id", "text"), count_words, "doc_id bigint, words bigint", 16)


def q_map_values(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", udf.map_values(F.col("lang"), str.upper, "string").alias("lang"))


# --- reports ------------------------------------------------------------------------


def scored_events(spark, sf_dir) -> DataFrame:
    """Events as scored rows: one kind has no statement, one has a bad score text."""
    kind = F.col("event_type")
    score = F.when(kind == "error", "x").otherwise(F.regexp_extract("props", r"(\d+)", 1))
    return table(spark, sf_dir, "events").select(
        "event_id", kind.alias("target_text"), F.col("props").alias("predicted_if"), score.alias("prediction_score"),
        (kind != "view").alias("has_if"), "value",
    )


def q_to_numeric_mean(spark, sf_dir):
    rows = summary.masked_rows(scored_events(spark, sf_dir))
    return summary.mean_score(rows).select("rows", F.round("mean_score", 4).alias("mean_score"))


def q_worst_best_topk(spark, sf_dir):
    rows = scored_events(spark, sf_dir).filter("has_if")
    columns = ["event_id", "target_text", "predicted_if", "value"]
    worst = summary.worst_predictions(rows, 10, "value", "event_id").select(F.lit("worst").alias("side"), *columns)
    best = summary.best_predictions(rows, 10, "value", "event_id").select(F.lit("best").alias("side"), *columns)
    return worst.unionByName(best)


def q_score_histogram(spark, sf_dir):
    bins = summary.score_histogram(table(spark, sf_dir, "events"), "value")
    return bins.select(F.col("bin").cast("bigint").alias("bin"), F.round("lo", 4).alias("lo"), F.round("hi", 4).alias("hi"), "n")


def q_loss_history(spark, sf_dir):
    evals = F.col("event_type") == "purchase"
    log = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("step"),
        (F.col("event_id") / 1000).alias("epoch"),
        F.when(~evals, F.col("value")).alias("loss"),
        F.when(evals, F.col("value")).alias("eval_loss"),
    )
    best = training_log.best_checkpoint(log).select(F.struct("*")).scalar()
    return training_log.loss_summary(log).withColumn("_b", best).select("*", "_b.*").drop("_b")


def q_loss_history_file(spark, sf_dir):
    """The training log of ``loss_history`` written as state files and read back by the reader."""
    evals = F.col("event_type") == "purchase"
    log = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("step"),
        (F.col("event_id") / 1000).alias("epoch"),
        F.when(~evals, F.col("value")).alias("loss"),
        F.when(evals, F.col("value")).alias("eval_loss"),
    )
    path = f"{Staging(spark).base}/trainer_state"
    writers.write_loss_history(log, path)
    read = readers.read_loss_history(spark, path)
    best = training_log.best_checkpoint(read).select(F.struct("*")).scalar()
    return training_log.loss_summary(read).withColumn("_b", best).select("*", "_b.*").drop("_b")


def q_loss_by_epoch(spark, sf_dir):
    log = table(spark, sf_dir, "events").select((F.col("event_id") / 1000).alias("epoch"), F.col("value").alias("loss"))
    return training_log.loss_by_epoch(log).select("bucket", "entries", F.round("mean_loss", 4).alias("mean_loss"))


# --- files ----------------------------------------------------------------------------


def q_csv_round_trip(spark, sf_dir):
    """Function rows written as CSV in two appends, then read back."""
    path = f"{Staging(spark).base}/functions"
    docs = documents(spark, sf_dir)
    rows = docs.select(
        F.col("source").alias("repo_name"), F.lit("").alias("repo_url"), F.col("doc_id").cast("string").alias("file_path"),
        F.lit("NA").alias("function_name"), F.lit(1).alias("start_line"),
        (newline_count(F.col("text")) + 1).cast("int").alias("end_line"), F.lit('a "b", c').alias("signature"),
        F.col("text").alias("original_code"), F.when(F.col("lang") == "en", code_tokens(F.col("text"))).alias("code_tokens"),
    )
    writers.write_functions(rows.filter("repo_name < 'src3'"), path, "csv")
    writers.write_functions(rows.filter("repo_name >= 'src3'"), path, "csv")
    return readers.read_functions(spark, path)


def q_corpus_text(spark, sf_dir):
    """The tokenizer corpus written as text; its lines read back and counted."""
    path = f"{Staging(spark).base}/corpus"
    writers.write_corpus(bpe.corpus(documents(spark, sf_dir), "text"), path, "text")
    return spark.read.text(path, lineSep="\n").groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


def q_pretrain_csv(spark, sf_dir):
    """Id lists written as quoted text, read as strings and parsed again."""
    path = f"{Staging(spark).base}/pretrain"
    rows = table(spark, sf_dir, "orders").select(
        F.array(F.col("o_orderkey").cast("int"), F.lit(7)).alias("input_ids"),
        F.array(F.lit(-100), (F.col("o_custkey") % 7).cast("int")).alias("labels"),
        function_code().alias("original_code_snippet"),
    )
    writers.write_pretrain(rows, path)
    columns = ["input_ids", "labels", "original_code_snippet"]
    back = readers.parse_int_list(readers.read_as_strings(spark, path, columns), ["input_ids", "labels"])
    return back.select(
        F.element_at("input_ids", 1).alias("id"), F.element_at("labels", 2).alias("label"), "original_code_snippet"
    )


def q_splits_written(spark, sf_dir):
    """Fine-tuning parts written to one folder each, then read back."""
    path = f"{Staging(spark).base}/splits"
    # stored once: the exact split reads its keys several times, the statements are searched once
    pairs = Staging(spark).put(_masked_code(spark, sf_dir).select("o_orderkey", "target_text"), "pairs")
    masked = splits.split_dataset(pairs, "o_orderkey", SEED)
    writers.write_splits(masked.select("o_orderkey", "target_text", "split"), path)
    return spark.read.parquet(path).select("o_orderkey", "target_text", F.col("split").cast("string").alias("split"))


def q_repo_lists(spark, sf_dir):
    """Repository names through a CSV table, their URLs through a text list."""
    base = Staging(spark).base
    name = F.concat(F.lower("c_mktsegment"), F.lit("/tool-"), (F.col("c_custkey") % 97).cast("string"))
    writers.write_results(table(spark, sf_dir, "customer").select(name.alias("name"), "c_custkey"), f"{base}/repos")
    writers.write_url_list(repos.repo_urls(readers.read_repo_table(spark, f"{base}/repos")), f"{base}/urls")
    return readers.read_url_list(spark, f"{base}/urls").select("url")


def source_tree(spark, sf_dir) -> DataFrame:
    """One file per page: empty ``__init__.py`` files, broken ones, notes of another suffix, functions with copies."""
    n = F.col("page_id")
    number, kind = n.cast("string"), (n % 50).cast("string")
    name = F.when(n % 5 == 0, F.concat(F.lit("p"), number, F.lit("/__init__.py")))
    name = name.when(n % 11 == 2, F.concat(F.lit("note"), number, F.lit(".txt"))).otherwise(F.concat(F.lit("m"), number, F.lit(".py")))
    function = F.concat(F.lit("def f_"), kind, F.lit("(x):\n    y = x\n    return y + "), kind, F.lit("\n"))
    text = F.when(n % 5 == 0, "").when(n % 7 == 1, "def (:\n").otherwise(function)
    path = F.concat(F.lit("repo"), (n % 20).cast("string"), F.lit("/"), name)
    return table(spark, sf_dir, "pages").select(path.alias("path"), F.encode(text, "UTF-8").alias("content"))


def q_collect_flow(spark, sf_dir):
    """A tree of files written, collected, and the lines of its report."""
    base = Staging(spark).base
    writers.write_files(source_tree(spark, sf_dir), f"{base}/tree")
    names = table(spark, sf_dir, "pages").select(F.concat(F.lit("own/repo"), (F.col("page_id") % 20).cast("string")).alias("name"))
    writers.write_url_list(repos.repo_urls(names), f"{base}/urls")
    rows, counters = collect.collect_functions(spark, f"{base}/tree", f"{base}/urls")
    writers.write_functions(rows, f"{base}/functions")
    writers.write_report(collect.description(counters), f"{base}/report")
    written = readers.read_functions(spark, f"{base}/functions", "parquet").agg(F.concat(F.lit("rows: "), F.count("*").cast("string")).alias("line"))
    return spark.read.text(f"{base}/report").select(F.col("value").alias("line")).unionByName(written)


def q_scored_report(spark, sf_dir):
    """Scored rows through CSV, then the whole report in one table."""
    path = f"{Staging(spark).base}/scored"
    rows = scored_events(spark, sf_dir).select(
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("code"), F.lit('a "b",\nc').alias("input_text"), "target_text", "has_if",
        "predicted_if", "prediction_score", "value")
    writers.write_results(rows.select("code", "input_text", "target_text", "has_if", "predicted_if", "prediction_score", F.col("value").alias("perplexity")), path)
    parts = summary.report(readers.read_scored(spark, path), key="code")
    mean = parts["mean"].select(F.lit("mean").alias("part"), F.lit("").alias("name"), F.col("rows").alias("n"), F.round("mean_score", 4).alias("score"))
    ends = [parts[p].select(F.lit(p).alias("part"), F.col("predicted_if").alias("name"), F.lit(1).cast("bigint").alias("n"),
                            F.col("prediction_score").alias("score")) for p in ("worst", "best")]
    bins = parts["histogram"].select(F.lit("histogram").alias("part"), F.col("bin").cast("string").alias("name"), "n", F.round("lo", 4).alias("score"))
    return mean.unionByName(ends[0]).unionByName(ends[1]).unionByName(bins)


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_")}
