"""Training-data pipeline: five stages over documents, each written and reread."""

from __future__ import annotations

from paylake.llm.common import materialize, table, tune
from paylake.llm.dartminhash import drop_near_duplicates
from paylake.llm.decontaminate import drop_contaminated
from paylake.llm.exact_dedup import drop_exact_duplicates
from paylake.llm.ga_packing import pack_documents
from paylake.llm.text_cnn import drop_toxic


def toxicity(spark, docs, sf_dir):
    """Documents that the classifier doesn't reject."""
    tune(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark, docs, sf_dir):
    """Of equal texts, the document with the smallest doc_id."""
    tune(spark)
    return drop_exact_duplicates(docs)


def near(spark, docs, sf_dir):
    """Of each class of near copies, the document with the smallest doc_id."""
    tune(spark)
    return drop_near_duplicates(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold no copy of a benchmark item."""
    tune(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark, docs, sf_dir):
    """Token pieces of the documents that stay, packed into sequences."""
    tune(spark)
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("exact", exact), ("near", near), ("decontamination", decontamination), ("packing", packing)]

#: Trained scores, signatures and token ids are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
