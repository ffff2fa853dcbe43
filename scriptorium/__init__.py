"""Spark-native preparation of language-model training data.

Subpackages: ``functions`` (Column-level building blocks), ``operators``
(DataFrame -> DataFrame steps), ``sources`` (corpus, JSONL and sinks),
``plans`` (end-to-end jobs, the registered queries with their DuckDB
oracles) and ``streaming`` (the stateless steps under Structured Streaming).

The most used entry points are re-exported here.
"""

__version__ = "0.1.0"

from scriptorium.operators.batches import assign_batches, collate_pad  # noqa: E402
from scriptorium.operators.chat import (  # noqa: E402
    assemble_messages,
    ensure_system,
    inference_prompts,
    render_texts,
    sft_examples,
    sft_examples_from_turns,
    split_rejects,
)
from scriptorium.operators.clean import clean_corpus, clean_stats, marker_positions, strip_boilerplate  # noqa: E402
from scriptorium.operators.pack import (  # noqa: E402
    clm_labels,
    pack_sequences,
    pack_stats,
    packed_stats,
    preview_chunk,
    training_plan,
)
from scriptorium.operators.split import train_eval_split  # noqa: E402
from scriptorium.plans.jobs import CPTParams, SFTParams, prepare_cpt, prepare_sft  # noqa: E402
from scriptorium.session import checkpoint_root, materialize, ship_package  # noqa: E402
from scriptorium.sources.corpus import load_books  # noqa: E402
from scriptorium.sources.jsonl import read_chat_jsonl  # noqa: E402
