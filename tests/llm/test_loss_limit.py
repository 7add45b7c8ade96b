"""The pipeline's limit of losses looks at every learned document."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.llm import language_id


def test_the_one_worst_of_many_documents_sets_the_limit(spark):
    rng = np.random.default_rng(5)
    words = {lang: ["".join(rng.choice(list(letters), 5)) for _ in range(40)] for lang, letters in (("aa", "abcdefgh"), ("zz", "stuvwxyz"))}
    text = lambda lang, n: " ".join(rng.choice(words[lang], n))
    rows = [(i, lang, text(lang, 12)) for i in range(6000) for lang in (("aa", "zz")[i % 2],)]
    rows.append((6001, "aa", text("aa", 13) + " " + text("zz", 11)))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(8)
    model = language_id.learn(docs, F.lit(True))
    loss = model.losses(language_id.ngram_counts([t for _, _, t in rows])[0])
    own = np.array([model.labels.index(lang) for _, lang, _ in rows])
    right = loss.argmin(1) == own
    assert right[-1] and loss.min(1)[right].argmax() == right.sum() - 1
    assert language_id.loss_limit(docs, model, F.lit(True)) == pytest.approx((min(loss.min(1)[right].max(), 1) + 1) / 2)
