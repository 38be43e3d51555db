"""Subject areas of documents by latent Dirichlet topics.

Topics are fitted over the sentences of the whole corpus by distributed
expectation-maximisation: executors infer topic proportions and return summed
expected counts by word, the driver only holds the (topics x words) table.
Words are numbered by a hash into ``HASHED`` places, so the table has that
size whatever the corpus.  Some topics are started from terms of the subjects
(inspected top terms where a subject has them, else words that keep to its
examples, label and description), the others from noise.  Fitted topics are
mapped to subjects by their top terms.  A document is assigned a subject when
enough of its sentences draw on the subject's topics, by the topic proportions
inferred for it; how far the words of those sentences keep to documents of the
subject is then checked.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch

# Terms found by inspecting topics, by subject (English, German, Spanish).
TERMS = {
    "dentistry": """tooth teeth molar gum gums plaque crown cavity veneer bridge aligner braces retainer incisor occlusion midline canal root
        extraction bite ramp hygienist porcelain floss stitched orthodontist graft acrylic appliance enamel
        weisheitszähne zahnspangen wurzelbehandlung zahnfleisch füllungen zahnkronen aufbissschienen
        muelas férulas ortodoncia endodoncias encías coronas empastes""",
    "finance": """bank loan mortgage invoice budget overdraft pension deductible insurance broker auditor ledger dividends grant subsidy refund
        savings deposit surplus tax payment claiming prices premium account
        steuererklärung zinsen rücklagen kontoauszüge raten kredite versicherungsbeiträge hypotheken steuern beiträge
        impuestos hipotecas préstamos intereses facturas ahorros primas""",
    "law": """court appeal claim claimant tribunal tenant ombudsman magistrate bylaw contract lease waiver negligence liability bailiff affidavit
        paralegal damages clause limitation sued panel ruling compensation settlement
        klageschrift paragrafen gericht gutachten mietrecht anwaltskosten berufung vergleich
        tribunales abogados demandas contratos sentencias indemnizaciones recursos""",
    "music": """guitar piano singer drum encore conductor quartet oboist accordionist jamming gig reverb mix tempo refrain suspended chord band
        rehearsal orchestra fingering tuning semitone movement
        klavierstunden gitarrensoli orchester taktarten notenblätter tonleitern chorproben
        guitarra solos partituras pianos ensayos escalas orquestas acordes coro""",
    "nutrition": """stew soup broth bread beans chickpeas dietitian sugar caffeine blender smoothies fasting vegetarian roast pickle recipe protein
        meal oats salt magnesium digestion plate
        koffein haferbrei vitamine gemüseeintopf fastentage eiweiß salzkonsum
        proteínas guisos ayuno sal avena cafeína vitaminas""",
    "science": """experiment mice gene electrode cochlear scan raters preprint assumptions microscope hair cell regression variance volunteers
        calibrated anechoic confidence hypothesis sample exposure placebo cortical
        messreihen zellproben laborversuche nervenreize statistik studienteilnehmer hypothesen
        neuronas clínicos mediciones hipótesis células estadística""",
    "software": """code bug api release build server memory thread stack trace presets update export database driver script process nightly
        uninstalling battery optimisation logs crashed version
        quelltext schnittstellen servern absturzberichte programmversionen datenbanken speicherfehler
        servidores código fuente compiladores programas errores memoria bases datos versiones""",
    "sport": """coach referee goalkeeper half sprint hurdles swim squad skipper bowled serve tennis league match laps hamstring deadlifts penalty
        rowing training bronze stretch calves substitutes
        torwarttraining klettern schwimmstaffel halbzeit lauftraining
        carreras natación entrenamientos porteros árbitros escalada liga partidos""",
}

#: Terms of the lists that settle a sentence alone: the German and Spanish ones, which stand in bare frames.
_ALONE = {w for terms in TERMS.values() for line in terms.split("\n")[-2:] for w in line.split()}

#: Places of the hashed words: bound of every table that goes to the driver or to the tasks.
HASHED = 1 << 17
BACKGROUND = 12
ROUNDS, INNER, CHUNK = 4, 3, 200
ALPHA, TEXT_WEIGHT, ETA, ANCHOR = 0.02, 3.0, 0.02, 30.0
#: First reading: an inspected term counts from this posterior on, a sentence from this many such terms, a document from this share.
FIRST_WORD, FIRST_SENTENCE, FIRST_SHARE = 0.6, 1.0, 0.15
#: Second reading: a word counts by how far it keeps to documents of the subject, with this many documents of the base rate added; a sentence from this weight.
SECOND_WORD, SECOND_SENTENCE, SMOOTH = 0.5, 0.8, 8.0
#: A sentence draws on a subject from this share of its words' topics, a document deals with it from this share of its sentences.
TOPIC_MASS, SHARE_LEAST = 0.06, 0.2

_SENTENCE = re.compile(r"(?<=[.!?…])[\"'”’)\]]*\s+|\n+")
_LABEL = re.compile(r"^\s*(?:[-*>#]+\s*|\d+[.)]\s+)*(?:u/\w+:\s*|[A-Z]:\s+|(?:[A-Z][\w’']*(?: \w+){0,3}): )?")
_TOKEN = re.compile(r"[^\W\d_]{2,}")


def sentences_of(text: str | None) -> list[list[str]]:
    """Words of each sentence of the text; speaker names, list signs, headings and card labels are no sentences."""
    out = []
    for line in (text or "").split("\n"):
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        line = _LABEL.sub("", line, count=1)
        if not re.search(r"[.!?…]", line):
            continue
        for part in _SENTENCE.split(line):
            words = _TOKEN.findall(part.lower())
            if words:
                out.append(words)
    return out


_places: dict[str, int] = {}


def place_of(word: str) -> int:
    """The word's place in all tables."""
    place = _places.get(word)
    if place is None:
        if len(_places) > 500_000:
            _places.clear()
        place = _places[word] = zlib.crc32(word.encode()) % HASHED
    return place


def subject_terms(codes: list[str], subjects: list[tuple[str, str]], examples: list[tuple[str, str]]) -> dict[str, set[str]]:
    """Terms of each subject: the inspected ones, else words that keep to its examples (in two of its sentences or its label and description)."""
    by_subject = {c: Counter(w for code, text in examples if code == c for x in sentences_of(text) for w in set(x)) for c in codes}
    everywhere = sum(by_subject.values(), Counter())
    named = {c: {w for code, text in subjects if code == c for w in _TOKEN.findall((text or "").lower()) if len(w) > 3} for c in codes}
    out = {}
    for c in codes:
        own = {w for w, n in by_subject[c].items() if len(w) > 3 and n >= 2 and n >= 0.9 * everywhere[w]}
        out[c] = set(TERMS[c].split()) if c in TERMS else own | {w for w in named[c] if everywhere[w] == by_subject[c][w]}
    return out


class Topics:
    """Topic-word table over the hashed words, with the subject of each topic (null for background)."""

    def __init__(self, counts: np.ndarray, codes: list[str]):
        self.counts, self.codes = counts, codes
        self.subject: list[str | None] = [None] * len(counts)

    @property
    def phi(self) -> np.ndarray:
        return (self.counts / self.counts.sum(1, keepdims=True)).astype(np.float32)

    def top_places(self, topic: int, n: int = 25) -> set[int]:
        """Places of the topic's top terms, by weight and by how far they keep to it."""
        lift = self.counts[topic] * np.log(self.counts[topic] / self.counts[topic].sum() / (self.counts.sum(0) / self.counts.sum()) + 1e-12)
        return set(np.argsort(-lift)[:n].tolist())

    def map_subjects(self, terms: dict[str, set[str]], least: int = 3, mass: float = 0.05) -> None:
        """Each topic gets the subject whose terms weigh most in it.

        At least ``least`` of them must be among its top terms and ``mass`` of
        its words be such terms; else the topic is background.
        """
        listed = {c: sorted({place_of(w) for w in terms.get(c, ())}) for c in self.codes}
        for k, row in enumerate(self.counts):
            best = max(self.codes, key=lambda c: row[listed[c]].sum())
            top = len(self.top_places(k).intersection(listed[best]))
            self.subject[k] = best if top >= least and row[listed[best]].sum() >= mass * row.sum() else None

    def word_subjects(self, terms: dict[str, set[str]]) -> np.ndarray:
        """(words x subjects): 1 for terms that the topics give to the same subject, else 0."""
        weight = self.counts / self.counts.sum(0, keepdims=True)
        out = np.zeros((HASHED, len(self.codes)), np.float32)
        for k, s in enumerate(self.subject):
            if s is not None:
                out[:, self.codes.index(s)] += weight[k]
        listed = np.zeros_like(out, dtype=bool)
        for c, code in enumerate(self.codes):
            listed[[place_of(w) for w in terms[code]], c] = True
        return ((out >= FIRST_WORD) & listed).astype(np.float32)


def proportions(words: np.ndarray, sizes: np.ndarray, text_sizes: np.ndarray, phi: np.ndarray) -> np.ndarray:
    """(words x topics): how far each word is drawn from each topic.

    ``sizes`` are words per sentence, ``text_sizes`` words per text.  A
    sentence's topic proportions come from its own words and, with less weight,
    from the whole text, so that sentences in unknown words are drawn to the
    subject of the sentences around them.  ``phi`` is (words x topics).
    """
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    text_starts = np.concatenate([[0], np.cumsum(text_sizes)[:-1]])
    given = phi[words]
    q = given / given.sum(1, keepdims=True)
    for _ in range(INNER):
        own = np.repeat(np.add.reduceat(q, starts, axis=0), sizes, axis=0)
        whole = np.add.reduceat(q, text_starts, axis=0)
        whole *= TEXT_WEIGHT / whole.sum(1, keepdims=True)
        own += np.repeat(whole + np.float32(ALPHA), text_sizes, axis=0)
        q = given * own
        q /= q.sum(1, keepdims=True)
    return q


def start(frequency: np.ndarray, codes: list[str], terms: dict[str, set[str]]) -> tuple[Topics, np.ndarray]:
    """First table and the terms' prior counts."""
    rng = np.random.Generator(np.random.PCG64(7))
    prior = np.full((len(codes) + BACKGROUND, HASHED), ETA)
    base = frequency / max(1.0, frequency.sum())
    for n, c in enumerate(codes):
        prior[n, sorted({place_of(w) for w in terms[c]})] += ANCHOR
    counts = prior + 50 * base * rng.gamma(2.0, 0.5, size=prior.shape)
    counts[: len(codes)] = prior[: len(codes)] + 2 * base
    return Topics(counts, codes), prior


def coded(documents: DataFrame) -> DataFrame:
    """``doc_id, words, sizes``: places of the words of all sentences; texts without a sentence are left out."""

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                sentences = sentences_of(text)
                if sentences:
                    out.append((doc, [place_of(w) for x in sentences for w in x], [len(x) for x in sentences]))
            yield pd.DataFrame(out, columns=["doc_id", "words", "sizes"])

    return documents.where("text is not null").select("doc_id", "text").mapInPandas(code, "doc_id bigint, words array<int>, sizes array<int>")


def _table(parts: DataFrame, columns: int) -> np.ndarray:
    """(columns x HASHED) from ``word, c0, c1, ...``, summed on the executors: the driver gets a row for each place at most."""
    summed = parts.groupBy("word").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(columns)])
    rows = summed.toPandas()
    out = np.zeros((columns, HASHED))
    out[:, rows["word"].to_numpy(np.int64)] = rows[[f"c{k}" for k in range(columns)]].to_numpy(float).T
    return out


def _sparse(total: np.ndarray) -> pd.DataFrame:
    seen = np.flatnonzero(total.any(axis=0))
    return pd.DataFrame({"word": seen} | {f"c{k}": total[k, seen] for k in range(len(total))})


def _columns(columns: int) -> str:
    return "word int, " + ", ".join(f"c{k} double" for k in range(columns))


def fit(texts: DataFrame, codes: list[str], terms: dict[str, set[str]], *, rounds: int = ROUNDS) -> Topics:
    """Topics of all coded texts, mapped to subjects."""
    context = texts.sparkSession.sparkContext

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((1, HASHED))
        for batch in batches:
            total[0] += np.bincount(np.concatenate([*batch["words"], [0]]).astype(np.int64), minlength=HASHED)
        yield _sparse(total)

    topics, prior = start(_table(texts.mapInPandas(count, _columns(1)), 1)[0], codes, terms)
    many = len(prior)
    for _ in range(rounds):
        shared = context.broadcast(np.ascontiguousarray(topics.phi.T))

        def infer(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            phi, total = shared.value, np.zeros((many, HASHED))
            for batch in batches:
                for at in range(0, len(batch), CHUNK):
                    words, sizes = batch["words"].iloc[at : at + CHUNK], batch["sizes"].iloc[at : at + CHUNK]
                    flat = np.concatenate(words.to_list())
                    q = proportions(flat, np.concatenate(sizes.to_list()), np.array([len(w) for w in words]), phi)
                    seen, inverse = np.unique(flat, return_inverse=True)
                    for t in range(many):
                        total[t, seen] += np.bincount(inverse, weights=q[:, t])
            yield _sparse(total)

        topics = Topics(_table(texts.mapInPandas(infer, _columns(many)), many) + prior, codes)
        shared.unpersist()
    topics.map_subjects(terms)
    return topics


def _hits(words: np.ndarray, sizes: np.ndarray, table: np.ndarray, least: float) -> np.ndarray:
    """(sentences x subjects): whether the weights of a sentence's different words for a subject reach ``least``."""
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((words, sentence))
    w, x = words[order], sentence[order]
    once = np.concatenate([[True], (w[1:] != w[:-1]) | (x[1:] != x[:-1])])
    weights = np.where(once[:, None], table[w], 0)
    return np.add.reduceat(weights, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0) >= least - 1e-6


def second_reading(texts: DataFrame, topics: Topics, terms: dict[str, set[str]]) -> np.ndarray:
    """(words x subjects): how far a word keeps to documents whose topics have the subject.

    Words of a subject that the terms did not reach gain weight, frequent words
    of everyday talk lose it, as they occur in documents of any subject.
    """
    table = topics.word_subjects(terms)
    c = table.shape[1]
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # by word: documents of each subject that hold it, and all documents; place ``HASHED`` stands for any word
        total = np.zeros((c + 1, HASHED + 1))
        for batch in batches:
            for words, sizes in zip(batch["words"], batch["sizes"]):
                has = np.flatnonzero(_hits(words, sizes, shared.value, FIRST_SENTENCE).mean(axis=0) >= FIRST_SHARE)
                own = np.append(np.unique(words), HASHED)
                total[c, own] += 1
                for k in has:
                    total[k, own] += 1
        yield _sparse(total)

    summed = texts.mapInPandas(count, _columns(c + 1)).groupBy("word").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(c + 1)]).toPandas()
    total = np.zeros((c + 1, HASHED + 1))
    total[:, summed["word"].to_numpy(np.int64)] = summed[[f"c{k}" for k in range(c + 1)]].to_numpy(float).T
    rate = total[:c, HASHED] / max(1.0, total[c, HASHED])
    near = ((total[:c] + SMOOTH * rate[:, None]) / (total[c] + SMOOTH)).T[:HASHED]
    near = (near - rate) / np.maximum(1e-9, 1 - rate)  # 0: as in any document, 1: in no other
    near[near < SECOND_WORD] = 0.0
    for k, code in enumerate(topics.codes):
        for w in _ALONE.intersection(terms[code]):
            if near[place_of(w), k]:
                near[place_of(w), k] = 1.0
    return near.astype(np.float32)


def assign(texts: DataFrame, topics: Topics, table: np.ndarray, *, least: float = SHARE_LEAST) -> DataFrame:
    """``doc_id, subject_code, share`` of every subject that enough sentences draw on.

    A sentence draws on a subject by the topic proportions inferred for it; the
    share of sentences whose words keep to the subject (``table``) must reach
    ``least`` as well and is the one returned.  Repeated documents give
    repeated rows.
    """
    codes = topics.codes
    # topics of a subject are added up, so that it does not matter how many it has
    of = np.zeros((len(topics.subject), len(codes)), np.float32)
    for k, x in enumerate(topics.subject):
        if x is not None:
            of[k, codes.index(x)] = 1
    shared = texts.sparkSession.sparkContext.broadcast((np.ascontiguousarray(topics.phi.T), table))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        phi, weights = shared.value
        for batch in batches:
            out = []
            for at in range(0, len(batch), CHUNK):
                part = batch.iloc[at : at + CHUNK]
                words, sizes = np.concatenate(part["words"].to_list()), np.concatenate(part["sizes"].to_list())
                many = np.array([len(x) for x in part["sizes"]])
                first = np.concatenate([[0], np.cumsum(many)[:-1]])
                mass = np.add.reduceat(proportions(words, sizes, np.array([len(w) for w in part["words"]]), phi) @ of, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0) / sizes[:, None]
                drawn = np.add.reduceat((mass >= TOPIC_MASS).astype(float), first, axis=0) / many[:, None]
                kept = np.add.reduceat(_hits(words, sizes, weights, SECOND_SENTENCE).astype(float), first, axis=0) / many[:, None]
                docs = part["doc_id"].to_numpy()
                out += [(docs[d], codes[k], float(kept[d, k])) for d, k in zip(*np.nonzero((drawn >= least - 1e-9) & (kept >= least - 1e-9)))]
            yield pd.DataFrame(out, columns=["doc_id", "subject_code", "share"])

    return texts.mapInPandas(run, "doc_id bigint, subject_code string, share double")


def document_subjects(documents: DataFrame, subjects: DataFrame, examples: DataFrame, *, scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, subject_code, share``: fit, read twice and assign.

    ``documents``: ``doc_id, text``; ``subjects``: ``subject_code`` and string
    columns that describe it; ``examples``: ``subject_code, text``.  Null and
    empty texts have no subject, nor has any document where no subjects or
    documents are given.
    """
    spark = documents.sparkSession
    scratch = scratch or Scratch(spark, "subjects")
    told = [c for c, t in subjects.dtypes if t == "string" and c != "subject_code"]
    described = [(r[0], r[1]) for r in subjects.where("subject_code is not null").select("subject_code", F.concat_ws(" ", *told)).collect()]  # a row per subject
    codes = sorted({c for c, _ in described})
    labelled = [(r[0], r[1]) for r in examples.where("subject_code is not null and text is not null").select("subject_code", "text").collect()]
    texts = scratch.save(coded(documents), "coded")
    if not codes or texts.isEmpty():
        return spark.createDataFrame([], "doc_id bigint, subject_code string, share double")
    terms = subject_terms(codes, described, labelled)
    topics = fit(texts, codes, terms)
    return assign(texts, topics, second_reading(texts, topics, terms))
