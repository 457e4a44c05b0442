"""How a corpus' files are to be read, asked of a model and tried on samples before it is used."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lodestone.plans.growth import reply_json
from lodestone.plans.model import ManagedModel
from lodestone.sources.corpus import ExtractionSpec, extract_documents, sample_files, usable_files

SHOWN = 1200
_ASK = """These are the heads of files of one corpus. Say how its documents' plain text is found.

{samples}

Reply with one JSON object and nothing else. Its names: "format" (jsonl: an object a line; json: a file is an object or an array of
them; csv; text: a file is a document), "text_fields" (a list of dotted paths, of which the first with text counts; a path may lead to a
string, or to an object or array of strings), "join_dict_field" and "join_list_field" (the name of an object or array whose strings make
the text, or null), "title_field" (or null), "delimiter" (of csv), "notes" (one sentence)."""
_AGAIN = """The specification {spec} found text in {good} of {all} files; a sample of it: {sample!r}.
Reply with one corrected JSON object with the same names."""


def infer_spec(spark: SparkSession, samples: dict[str, str], model: ManagedModel, attempts: int = 2) -> ExtractionSpec | None:
    """A specification that finds text in at least half of the samples (path to head); None if there is none, so that the plain reading is used."""
    if not samples:
        return None
    files = spark.createDataFrame(list(samples.items()), "path string, raw string")
    prompt = _ASK.format(samples="\n\n".join(f"--- {name} ---\n{head[:SHOWN]}" for name, head in samples.items()))
    for _ in range(max(1, attempts)):
        try:
            reply = reply_json(model.complete(prompt, "ingest"))
            spec = ExtractionSpec.of(reply if isinstance(reply, dict) else {})
        except (ValueError, TypeError):
            return None
        good = usable_files(extract_documents(files, spec)).collect()  # a row for each sample
        if good and 2 * len(good) >= len(samples):
            return spec
        prompt = _AGAIN.format(spec=spec.json(), good=len(good), all=len(samples), sample=good[0].sample if good else "")
    return None


def analyze_corpus(spark: SparkSession, folder: str, model: ManagedModel | None) -> ExtractionSpec | None:
    """The specification of a folder's files; None without a model."""
    if model is None:
        return None
    return infer_spec(spark, {r.path: r.head for r in sample_files(spark, folder).collect()}, model)
