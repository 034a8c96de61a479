"""Classifier chains: parts, learning from labelled texts, and held-out accuracy."""

import itertools
import random

import numpy as np

from quillmesh.llm import subjects

TERMS = {"law": ["court", "statute", "appeal", "defendant", "tenancy dispute"], "sport": ["sprint", "ice hockey", "coach", "referee", "stadium"], "physics": ["photon", "quantum state", "plasma", "neutron", "magnetic field"]}
TREATS = ["We examine how {0} relates to {1}.", "Little is known about {0}, and less about {1}.", "A new account of {0} is proposed.", "Results on {0} and {1} are reported."]
NAMES = ["An unrelated note on {0} appears elsewhere.", "A former section on {0} was closed in 2004.", "Manuscripts on {0} or {1} fall outside the scope."]
FILLER = ["Peer review is double-blind.", "The record was last revised in 1997.", "Volume 3 contains 120 pages."]


def document(rnd, labels):
    out = rnd.sample(FILLER, 2)
    for s in labels:
        out += [t.format(*rnd.sample(TERMS[s], 2)) for t in rnd.sample(TREATS, 3)]
    if rnd.random() < 0.6 and (rest := [s for s in TERMS if s not in labels]):
        out.append(rnd.choice(NAMES).format(*rnd.sample(TERMS[rnd.choice(rest)], 2)))
    rnd.shuffle(out)
    return " ".join(out)


def corpus(seed, n):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        labels = set(rnd.sample(list(TERMS), rnd.choice([0, 1, 1, 1, 2])))
        rows.append((document(rnd, sorted(labels)), rnd.choice(["abstract", None]), "en", "feed", labels))
    return rows


def test_sentences():
    assert subjects.sentences("<p>Größe: Foo-\nbar&nbsp;x. It's 12.5 km!</p>\n1. One\n2. Two") == [["grosse"], ["foobar", "x"], ["it", "s", "9", "9", "km"], ["9"], ["one"], ["9"], ["two"]]
    assert subjects.sentences("") == [] and subjects.sentences(" \t ") == []


def decode(model, rows):
    return [set(x) for x in model.decode(model.inputs(*zip(*[r[:4] for r in rows], strict=True)))]


def test_held_out_accuracy_and_passing_mentions():
    model = subjects.fit(corpus(1, 400), sorted(TERMS))
    test = corpus(2, 300)
    got = decode(model, test)
    hit = sum(len(g & r[4]) for g, r in zip(got, test, strict=True))
    assert hit / sum(map(len, got)) > 0.95 and hit / sum(len(r[4]) for r in test) > 0.93
    odd = ["An unrelated note on plasma appears elsewhere.", None, "", " \n", "x" * 200_000, "<" * 5000]
    assert decode(model, [(t, None, None, None) for t in odd]) == [set()] * len(odd)


def test_few_labels_lean_on_each_other():
    """Thirty labelled documents: what evidence means is learned over all subjects together."""
    model = subjects.fit(corpus(1, 30), sorted(TERMS))
    test = corpus(2, 300)
    got = decode(model, test)
    hit = sum(len(g & r[4]) for g, r in zip(got, test, strict=True))
    assert hit / sum(map(len, got)) > 0.9 and hit / sum(len(r[4]) for r in test) > 0.6


def test_batches_give_what_single_documents_give():
    model = subjects.fit(corpus(3, 120), sorted(TERMS))
    texts = [r[0] for r in corpus(7, 60)] + ["", "court court. Court!", "tenancy dispute tenancy dispute; quantum state"]
    docs = [subjects.sentences(t) for t in texts]
    evidence, used = model.evidence(docs)
    for d, row, u in zip(docs, evidence, used, strict=True):
        one = subjects.find_terms(d, model.terms, subjects.first_words(model.terms))
        assert np.allclose(row, subjects.features(one, model.odds, len(TERMS)), atol=1e-6) and u == len({k for k, *_ in one.mentions})
    assert model.evidence([])[0].shape == (0, 3 * subjects.FEATURES) and model.inputs([], [], [], []).shape[0] == 0


def test_notes_are_evidence():
    notes = subjects.prior_words([("law", "Law", "norms and courts"), ("sport", "Sport", "athletes and courts"), ("physics", None, None)], sorted(TERMS))
    assert notes == [{"norms", "law"} if s == "law" else {"athletes", "sport"} if s == "sport" else set() for s in sorted(TERMS)]
    model = subjects.fit(corpus(1, 60), sorted(TERMS), notes=notes)
    assert model.terms["athletes"][0] == sorted(TERMS).index("sport") and "and" not in model.terms


def test_chunks_keep_every_row():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["aaaa", None, "b" * 30, "", "cc", "dddd", "e" * 9])], names=["id", "text"])
    for most in (1, 5, 10, 1000):
        parts = list(subjects.chunks(batch, most))
        assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(7)) and all(len(p) for p in parts)


def test_a_sequence_of_two_documents_is_a_term_at_every_size():
    rows = [("Zyzzyva.", None, "en", "feed", {"law"})] * 2 + [(f"{TERMS[s][i % 3]}.", None, "en", "feed", {s}) for i, s in ((i, sorted(TERMS)[i % 3]) for i in range(1998))]
    for n in (1999, 2000):
        assert subjects.fit(rows[:n], sorted(TERMS)).terms["zyzzyva"][0] == sorted(TERMS).index("law")


def test_beam_finds_the_best_combination():
    model = subjects.fit(corpus(3, 120), sorted(TERMS))
    inputs = model.inputs(*zip(*[r[:4] for r in corpus(4, 25)], strict=True))
    for x, chosen in zip(inputs, model.best_combinations(inputs), strict=True):

        def joint(combo, x=x):
            score = 0.0
            for step, (w, (slope, shift)) in enumerate(zip(model.weights, model.scales, strict=True)):
                z = slope * (float(w[: len(x)] @ x) + w[-1] + sum(w[len(x) + k] for k in range(step) if combo[k])) + shift
                score -= np.logaddexp(0, -z if combo[step] else z)
            return score

        assert chosen.tolist() == [bool(v) for v in max(itertools.product([0, 1], repeat=3), key=joint)]


def test_assignment(spark):
    rows = corpus(5, 160)
    docs = [(i, r[0], "en", "feed", r[1], "clash") for i, r in enumerate(rows)] + [(900, None, None, None, None, "c"), (901, "", "en", "f", None, "c"), (902, " ", "en", "f", None, "c"), (903, rows[0][0], None, None, None, "c"), (903, rows[0][0], None, None, None, "c")]
    labels = [(i, s) for i, r in enumerate(rows[:120]) for s in (sorted(r[4]) or [None])] + [(5000, "law"), (None, "law")]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, doc_type string, subject string")
    lb = spark.createDataFrame(labels, "doc_id long, subject string")
    areas = spark.createDataFrame([(s, s) for s in TERMS], "subject string, oa_field string")
    out = subjects.assign_subjects(d, lb, areas)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and all(i >= 120 for i, _ in got) and not {i for i, _ in got} & {900, 901, 902}
    assert {s for i, s in got if i == 903} == rows[0][4]
    total = {r.subject: (r.n_documents, r.n_labelled) for r in subjects.corpus_by_subject(out, lb).collect()}
    assert total["law"][1] == len({i for i, s in labels if s == "law"}) and total["law"][0] >= total["law"][1]
    assert subjects.assign_subjects(d, lb.where("doc_id > 10000"), areas).count() == 0 and subjects.assign_subjects(d.where("doc_id < 0"), lb, areas).count() == 0
    bounded = subjects.labelled_rows(d, lb, most=50)
    assert len(bounded) <= 50 and bounded == subjects.labelled_rows(d.repartition(3), lb, most=50)
