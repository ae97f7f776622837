from gleanframe.operators.score import scored_answers
from gleanframe.session import shared_path
from gleanframe.spec import JOB_POSTING
from gleanframe.streaming.answers import score_stream, stream_predictions
from tests.jobs import gold_frame, preds_frame


def test_stream_scores_equal_batch_scores(spark):
    path, out, state = (shared_path(spark, n) for n in ("answers", "scores", "state"))
    gold = gold_frame(spark)
    first = preds_frame(spark, [("a", "r1", "{}"), ("a", "r2", '{"title": "Filing \\"Clerk\\""}')])
    later = preds_frame(spark, [("b", "r1", "no"), ("b", "r9", "{}")])

    def run_once():
        scores = score_stream(gold, stream_predictions(spark, path, files_per_trigger=1), JOB_POSTING)
        q = (scores.writeStream.format("parquet").option("checkpointLocation", state)
             .trigger(availableNow=True).start(out))
        assert q.awaitTermination(120)

    first.coalesce(1).write.mode("append").parquet(path)
    run_once()
    later.coalesce(1).write.mode("append").parquet(path)
    run_once()
    got = sorted(spark.read.parquet(out).collect())
    assert got == sorted(scored_answers(gold, first.unionByName(later), JOB_POSTING).collect())
    assert len(got) == 3
