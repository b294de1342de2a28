"""The stages that turn raw documents into training data, in order.

Every stage works on all rows that the stage before kept. It drops the rows it rejects, or
rewrites texts; the columns are those of `documents`, only the last stage adds the token ids.
"""

import public_tokenizers

from evrange.llm import byte_bpe, decontamination, simhash, surrogates, toxicity
from evrange.llm.common import read, staged
from evrange.llm.queries import KEY, SHINGLE, SIMHASH_BITS


def drop_toxic(spark, docs, sf_dir):
    """Documents that the grammar, fitted on the labelled rows among them, scores 0.5 or more go."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model)


def drop_near_duplicates(spark, docs, sf_dir):
    """Of each group of linked fingerprints the document of the smallest doc_id stays."""
    return simhash.keep_one(docs, SHINGLE, SIMHASH_BITS)


def drop_contaminated(spark, docs, sf_dir):
    """Documents that contain a passage of the benchmark go."""
    return decontamination.remove(docs, read(spark, sf_dir, "benchmark"))


def replace_personal_data(spark, docs, sf_dir):
    """Personal data become surrogates; n_chars follows the text."""
    return surrogates.replace(docs, KEY, length="n_chars" if "n_chars" in docs.columns else None)


def encode(spark, docs, sf_dir):
    """The token ids of each text, and the text that they decode to."""
    tokens = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.encode(docs, tokens, public_tokenizers.PATTERN)


STAGES = [("toxicity", drop_toxic), ("simhash near-duplicates", drop_near_duplicates),
          ("benchmark decontamination", drop_contaminated), ("personal data", replace_personal_data),
          ("byte-level BPE", encode)]

#: Fitted weights, fingerprints and surrogates are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Every stage in turn over the documents of `sf_dir`, each written once for the next."""
    docs = read(spark, sf_dir, "documents")
    *before, (_, last) = STAGES
    for _, stage in before:
        docs = staged(stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)
