import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opinara.session import build_session  # noqa: E402

TOPICS = "harbour lantern meadow ticket garden winter station river kitchen mirror violin market".split()
PRAISE = "superb charming radiant splendid delightful".split()
BLAME = "dull dreary stale clumsy lousy".split()


def drawn_texts(words, seed):
    """Ten texts of topic words with two or three of ``words``."""
    draw = random.Random(seed)
    return [" ".join(draw.sample(TOPICS, 6) + draw.sample(words, draw.choice([2, 3]))) + "." for _ in range(10)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        4,
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def review_rows(spark):
    """Sixty labelled rows, ten texts per class three times over, with an id."""
    rows = [(t, "positive") for t in drawn_texts(PRAISE, 1) * 3] + [(t, "negative") for t in drawn_texts(BLAME, 2) * 3]
    return spark.createDataFrame(
        [(i, t, s) for i, (t, s) in enumerate(rows)], "id bigint, review string, sentiment string"
    )
