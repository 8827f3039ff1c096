"""Text-message classification on Spark: k fold models, one vote per message."""

from textjury.operators.classifiers import ALGORITHMS, DEFAULT_NUM_FEATURES
from textjury.operators.evaluation import evaluate, macro_average
from textjury.operators.folds import assign_folds
from textjury.operators.voting import majority_vote
from textjury.operators.word_discovery import discover_words
from textjury.plans.boosting import load_boosted, score_boosted, train_boosted
from textjury.plans.registry import ModelStore
from textjury.plans.scoring import load_ensemble, predict, score, score_by_method, score_side_by_side
from textjury.plans.split import build_split, dictionary_tokenizer
from textjury.plans.training import retrain, train
from textjury.sources.lines import parse_labelled, read_labelled, read_messages
from textjury.operators.tokenizing import tokenize

__all__ = [
    "ALGORITHMS",
    "DEFAULT_NUM_FEATURES",
    "ModelStore",
    "assign_folds",
    "build_split",
    "dictionary_tokenizer",
    "discover_words",
    "evaluate",
    "load_boosted",
    "load_ensemble",
    "macro_average",
    "majority_vote",
    "parse_labelled",
    "predict",
    "read_labelled",
    "read_messages",
    "retrain",
    "score",
    "score_boosted",
    "score_by_method",
    "score_side_by_side",
    "tokenize",
    "train",
    "train_boosted",
]
