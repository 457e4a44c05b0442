"""Column functions over text: identifiers, tokens, chunks, n-grams, fingerprints, normal forms."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lodestone.functions.blocks import give_back


def slug(label: Column) -> Column:
    s = F.trim(F.regexp_replace(F.lower(label), r"(?U)[^\w]+", "-"), F.lit("-"))
    return F.when(s == "", "node").otherwise(s)


def node_id(label: Column) -> Column:
    return F.concat(F.lit("n_"), F.left(slug(label), F.lit(48)), F.lit("-"), F.left(F.sha1(F.lower(F.trim(label)).cast("binary")), F.lit(8)))


def label_key(label: Column) -> Column:
    """The form in which labels and aliases are compared."""
    return F.trim(F.regexp_replace(F.lower(label), r"(?U)\s+", " "))


def tokens(text: Column) -> Column:
    """ASCII words, then for each run of CJK characters its characters and its neighbouring pairs."""
    lower = F.lower(text)
    words = F.regexp_extract_all(lower, F.lit("[a-z0-9]+"), F.lit(0))
    runs = F.regexp_extract_all(lower, F.lit("[㐀-䶿一-鿿]+"), F.lit(0))
    ones = lambda r: F.transform(F.sequence(F.lit(1), F.length(r)), lambda i: F.substring(r, i, F.lit(1)))
    twos = lambda r: F.when(F.length(r) > 1, F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    return F.concat(words, F.flatten(F.transform(runs, lambda r: F.concat(ones(r), twos(r)))))


def chunks(text: Column, size: int, overlap: int) -> Column:
    """Stripped, non-empty windows; the last is the first that reaches the end. A size of 0 or less gives the whole text."""
    if size <= 0:
        whole = strip(text)
        return F.when(whole == "", F.array().cast("array<string>")).otherwise(F.array(whole))
    step = max(size - overlap, 1)
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / step)).cast("int")
    own = F.transform(F.sequence(F.lit(0), last), lambda i: strip(F.substring(text, i * step + 1, F.lit(size))))
    return F.filter(own, lambda x: x != "")


def word_ngrams(text: Column, n: int = 3) -> Column:
    """Distinct n-grams of white-space words; the words themselves if there are fewer than n."""
    words = F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda x: x != "")
    grams = F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.array_distinct(F.when(F.size(words) >= n, grams).otherwise(words))


_ASCII, _CJK = re.compile("[a-z0-9]+"), re.compile("[㐀-䶿一-鿿]+")


def token_list(text: str | None) -> list[str]:
    """What tokens() gives, for one text."""
    low = (text or "").lower()
    pairs = [[*r, *(r[i : i + 2] for i in range(len(r) - 1))] for r in _CJK.findall(low)]
    return _ASCII.findall(low) + [t for r in pairs for t in r]


#: What a worker holds as Python objects at once: some 2 MB of text.
SLICE_BYTES = 2_000_000


def simhash_one(text: str | None) -> int:
    """The signs of 64 summed bits of the MD5 of each token, or of each run of three tokens if there are four or more; 0 without tokens."""
    own = token_list(text)
    n = len(own) if len(own) < 4 else len(own) - 2
    if not n:
        return 0
    up = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        grams = own[at : at + 4096] if len(own) < 4 else [" ".join(own[i : i + 3]) for i in range(at, min(at + 4096, n))]
        raw = b"".join(hashlib.md5(g.encode()).digest()[:8] for g in grams)
        up += np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(up * 2 > n).tobytes(), "big", signed=True)


def slices_of(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of rows (from, to) with `most` bytes at most, or one row."""
    out, first, total = [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            out.append((first, i))
            first, total = i, 0
        total += n
    return [*out, (first, len(sizes))] if len(sizes) else out


@F.arrow_udf(LongType())
def simhash64(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """simhash_one of each text. Texts become Python objects in slices, so that memory doesn't follow the batch's size."""
    for batch in batches:
        found = np.zeros(len(batch), np.int64)
        for a, b in slices_of(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False), SLICE_BYTES):
            found[a:b] = [simhash_one(x) for x in batch[a:b].to_pylist()]
        yield pa.array(found)
        give_back()


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def strip(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


_URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(?:\?([^#]*))?"


def _form_value(raw: Column) -> Column:
    """A name or value of a query, decoded and encoded again; text that can't be decoded is encoded as it is."""
    plain = F.coalesce(F.try_url_decode(raw), raw)
    return F.replace(F.replace(F.url_encode(plain), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def normal_url(url: Column | str) -> Column:
    """Lower-case scheme and host, no utm_ parameters, no trailing slash, no fragment; parameters are encoded anew.

    A URL whose host has one of two brackets can't be parsed and is only stripped. Null stays null.
    """
    bare = strip(F.col(url) if isinstance(url, str) else url)
    whole = F.regexp_replace(bare, r"[\t\r\n]", "")
    part = lambda i: F.regexp_extract(whole, _URL, i)
    scheme, host, path, query = part(1), part(2), part(3), part(4)
    fields = F.filter(F.split(query, "&"), lambda x: x != "")
    pairs = F.transform(fields, lambda x: F.struct(_form_value(F.substring_index(x, "=", 1)).alias("k"), _form_value(F.when(F.contains(x, F.lit("=")), F.substring(x, F.locate("=", x) + 1, F.length(x))).otherwise("")).alias("v")))
    kept = F.filter(pairs, lambda x: ~F.startswith(F.lower(x["k"]), F.lit("utm_")))
    asked = F.array_join(F.transform(kept, lambda x: F.concat(x["k"], F.lit("="), x["v"])), "&")
    trimmed = F.regexp_replace(path, "/+$", "")
    rooted = F.when((host != "") & (trimmed != "") & ~F.startswith(trimmed, F.lit("/")), F.concat(F.lit("/"), trimmed)).otherwise(trimmed)
    out = F.concat(F.when(scheme != "", F.concat(F.lower(scheme), F.lit(":"))).otherwise(""), F.lower(host), rooted, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(""))
    return F.when(F.contains(host, F.lit("[")) != F.contains(host, F.lit("]")), bare).otherwise(out)


def answer_form(text: Column) -> Column:
    """Lower case, with runs of white space, signs and underscores as one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)[\s\W_]+", " "))


def json_part(text: Column) -> Column:
    """The JSON text of a model's reply: the reply without code fences if it parses, else its outermost braces, else brackets; null if none parses."""
    bare = F.trim(F.regexp_replace(F.trim(text), r"^```[A-Za-z]*\s*|\s*```$", ""))
    braces = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    brackets = F.regexp_extract(bare, r"(?s)\[.*\]", 0)
    ok = lambda x: F.when((x != "") & F.try_parse_json(x).isNotNull(), x)
    return F.coalesce(ok(bare), ok(braces), ok(brackets))
