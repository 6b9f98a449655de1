"""raresift: rare-event classification on Spark (batch and Structured Streaming).

The main entry points are re-exported here; everything else lives in
``functions``, ``sources``, ``operators``, ``sinks``, ``plans`` and
``streaming``.
"""

from raresift.functions.scoring import LinearScorer
from raresift.operators.clean import clean_table, sample_rows
from raresift.operators.evaluate import binary_areas, confusion_matrix
from raresift.operators.events import decode_messages, encode_messages
from raresift.operators.model import fit_classifier, load_model, save_model, score
from raresift.operators.profile import class_profile, with_class_weight
from raresift.operators.split import train_test_split
from raresift.plans.streaming_job import publish, run_stream_scoring
from raresift.plans.training import run_training
from raresift.session import build_session

__all__ = [
    "LinearScorer",
    "binary_areas",
    "build_session",
    "class_profile",
    "clean_table",
    "confusion_matrix",
    "decode_messages",
    "encode_messages",
    "fit_classifier",
    "load_model",
    "publish",
    "run_stream_scoring",
    "run_training",
    "sample_rows",
    "save_model",
    "score",
    "train_test_split",
    "with_class_weight",
]
