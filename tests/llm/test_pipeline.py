"""The pipeline against plain Python; what each stage decides takes effect on the next."""

from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from backglance.llm import decontam, toxicity
from backglance.llm.queries import byte_bpe
from tests.llm.test_bpe import wanted as digests
from tests.llm.test_decontam import brute
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.01"


def without_repeats(rows, window=20):
    seen, found = set(), []
    for doc, text in sorted(rows):
        words, raw = text.split(), text
        keep = [True] * len(words)
        for i in range(len(words) - window + 1):
            gram = tuple(words[i : i + window])
            if gram in seen:
                keep[i : i + window] = [False] * window
            seen.add(gram)
        if not all(keep):
            raw = " ".join(w for w, k in zip(words, keep) if k)
        if raw or not words:
            found.append((doc, raw))
    return found


def test_run_against_plain_python(spark):
    docs, labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    toxic = {r.doc_id for r in toxicity.score_toxicity(docs, labels).where("predicted = 1").collect()}
    rows = [(r.doc_id, r.text or "") for r in docs.collect() if r.doc_id not in toxic]
    prints = {d: plain_fingerprint(t) for d, t in rows}
    component, least = plain_components(set(prints.values()), 2), {}
    for doc, bits in prints.items():
        least[component[bits]] = min(doc, least.get(component[bits], doc))
    rows = without_repeats([(d, t) for d, t in rows if least[component[prints[d]]] == d])
    leaked = {d for d, _ in brute(rows, [(r.item_id, r.text) for r in items.collect()], decontam.SCORE, decontam.OVERLAP)[0]}
    library = Tokenizer.from_file(byte_bpe()["path"])
    wanted = {d: digests(library, t) for d, t in rows if d not in leaked}
    found = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == wanted
    assert toxic and leaked and len(wanted) < 1000 - len(toxic)


def test_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert {int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
