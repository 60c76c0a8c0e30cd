"""Every labelled text takes part in training, scale and thresholds."""

from __future__ import annotations

import random
import zlib

from genoloom.llm import toxicity
from genoloom.llm.common import ship


def test_no_labelled_text_is_left_out(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice(["lamp", "river", "vile" if k % 9 == 0 else "stone"]) for _ in range(8)), "en") for k in range(7000)]
    ship(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 9 == 0)) for k in range(7000)], "doc_id long, toxic int")
    seen, real = {}, toxicity.calibrate

    def counting(models, table):
        seen["n"], seen["models"] = table.count(), len(models)
        return real(models, table)

    monkeypatch.setattr(toxicity, "calibrate", counting)
    models, cuts = toxicity.fit(docs, labels)
    usable = sum(zlib.crc32(str(k).encode()) % 3 != 1 for k in range(7000))
    assert seen == {"n": usable, "models": 2} and usable > 4000
    score = models[0].score([toxicity.word_rows("lamp vile river"), toxicity.word_rows("lamp stone river")])
    assert score[0] > 0.7 > score[1] and 0 < cuts["en"] < 1
