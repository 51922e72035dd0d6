"""Text functions as column expressions. Lengths and positions are code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Closed word lists and patterns that results depend on.
DEDUP_STOP = (
    "a an and are as at be by for from has have how in is it its of on or that the their this to was were what when which who why with"
).split()
QUERY_STOP = "a an and are as at be by for from how in is it of on or that the this to was were what when which who why with".split()
TITLE_STOP = ["目录", "图像", "Images", "Table", "Figure", "附录", "参考", "References", "Introduction", "Abstract", "Conclusion", "Related", "Work"]
VARIANTS = (
    "这這 里裡 后後 为為 国國 东東 发發 应應 与與 条條 责責 权權 险險 综綜 简簡 证證 标標 额額 计計 须須 际際 续續 赔賠 审審 终終 并並 买買 卖賣"
).split()
TOKEN = "[A-Za-z]{2,}|[一-鿿]{2,}|\\p{Nd}+(?:\\.\\p{Nd}+)?"
LOCATION = "(第\\s*\\p{Nd}+\\s*页|page\\s*\\p{Nd}+|section_id|chunk_id|Figure\\s*\\p{Nd}+|Table\\s*\\p{Nd}+|图\\s*\\p{Nd}+|表\\s*\\p{Nd}+|第\\s*\\p{Nd}+\\s*章|chapter\\s*\\p{Nd}+)"
NUMBER = "(?<![A-Za-z0-9_])((?:-?\\p{Nd}{1,3}(?:,\\p{Nd}{3})*(?:\\.\\p{Nd}+)?|-?\\p{Nd}+(?:\\.\\p{Nd}+)?)(?:%|‰)?)"
PUNCTUATION = "[，。！？,.!?;；:：()（）\\[\\]{}\"'“”‘’]+"
SENTENCE_END = "[。！？；]|(?<!\\p{Nd})[.!?;](?!\\p{Nd})"
OTHER_CITATION = "(?i)(\\(\\s*\\p{Nd}+\\s*\\)|（\\s*\\p{Nd}+\\s*）|【\\s*\\p{Nd}+\\s*】|<\\s*sup\\s*>\\s*\\p{Nd}+\\s*<\\s*/\\s*sup\\s*>)"
GENERIC_CAPTIONS = ["test", "caption", "test caption", "image caption", "a caption", "n/a", "none", "null", "unknown", "untitled"]
GENERIC_NOUNS_EN = ["image", "figure", "diagram", "chart", "photo", "screenshot", "illustration", "table", "equation", "formula"]
GENERIC_NOUNS_ZH = ["图片", "图", "示意图", "图示", "插图", "照片", "表格", "公式"]
UNANSWERABLE = ["UNANSWERABLE", "无法回答", "無法回答"]

#: White space as text tools understand it: ASCII and the Unicode spaces.
SPACE = "\\x09-\\x0D\\x1C-\\x20\\x85\\xA0\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
#: The same characters, one by one.
SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: White space other than the plain one.
OTHER_SPACE = f"[[^ -~]&&[{SPACE}]]"
#: What isn't an ideograph, and neither that nor an ASCII letter or digit. Java takes several times as long over a
#: negated class of several ranges.
_NO_IDEOGRAPH = "[\\x00-\\x{4DFF}\\x{A000}-\\x{10FFFF}]"
_NO_IDENTIFIER = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x{4DFF}\\x{A000}-\\x{10FFFF}]+"
_UNSAFE = "[\\x00-,/\\x3A-\\x40\\x5B-\\x5E\\x60\\x7B-\\x{10FFFF}]+"


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(SPACES))


def blank(c: Column) -> Column:
    """Whether a text is white space alone; only its start is read."""
    return F.ltrim(c, F.lit(SPACES)) == ""


def collapse(c: Column) -> Column:
    """Runs of white space as single spaces, none at the ends."""
    return strip(F.regexp_replace(F.regexp_replace(c, f"{OTHER_SPACE}+", " "), " {2,}", " "))


def question_key(c: Column, variant: str = "strict") -> Column:
    """Key under which questions count as equal. `audit` trims and lower-cases; `writer` collapses white space
    too; `strict` removes punctuation as well."""
    low = F.lower(strip(text(c)))
    if variant != "audit":
        low = F.regexp_replace(low, f"[{SPACE}]+", " ")
    if variant == "strict":
        low = F.regexp_replace(low, PUNCTUATION, "")
    return F.substring(low, 1, 500)


def tokens(c: Column, stop: list[str]) -> Column:
    found = F.regexp_extract_all(F.lower(text(c)), F.lit(TOKEN), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(*stop))


def keywords(c: Column, most: int = 8) -> Column:
    return F.slice(F.array_distinct(tokens(c, QUERY_STOP)), 1, most)


def let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside lambdas (there, Spark would
    compute a plain expression again for every element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(numbers: Column, run: int = 256) -> Column:
    """Sums of the numbers up to each, in an array's row. Each step copies the sums of its run so far, hence runs."""
    last = lambda sums: F.get(sums, F.size(sums) - 1)

    def summed(some: Column, start: Column) -> Column:
        return F.aggregate(some, F.array().cast("array<bigint>"), lambda done, x: F.concat(done, F.array(F.coalesce(last(done), start) + x)))

    def told(xs: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(xs), F.lit(run)), lambda at: F.slice(xs, at + 1, run))
        return F.flatten(F.aggregate(runs, F.array().cast("array<array<bigint>>"), lambda done, xs: F.concat(done, F.array(summed(xs, F.coalesce(last(last(done)), F.lit(0).cast("long")))))))

    return let(numbers.cast("array<bigint>"), told)


def adjacent(words: Column, by: str) -> Column:
    """Pairs of neighbours, joined."""
    pairs = lambda w: F.transform(w, lambda x, i: F.concat(x, F.lit(by), F.get(w, i + 1)))
    return let(words, lambda w: F.slice(pairs(w), F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))))


def more_keywords(c: Column, base: Column, most: int = 10) -> Column:
    """Base keywords, then pairs of neighbours, up to `most`."""
    wide = keywords(c, most)
    return F.slice(F.array_distinct(F.concat(base, adjacent(wide, " "))), 1, most)


def text_keywords(c: Column, most: int = 10) -> Column:
    found = F.regexp_extract_all(text(c), F.lit("[0-9A-Za-z一-鿿]{2,14}"), F.lit(0))
    return F.slice(F.array_distinct(F.filter(found, lambda t: ~t.isin(*TITLE_STOP))), 1, most)


def number_tokens(c: Column, most: int = 8) -> Column:
    return F.slice(F.array_distinct(F.regexp_extract_all(text(c), F.lit(NUMBER), F.lit(1))), 1, most)


def without_commas(c: Column) -> Column:
    return F.replace(text(c), F.lit(","), F.lit(""))


def grounded(numbers: Column, evidence: Column) -> Column:
    """Whether every number occurs in the evidence, commas aside."""
    return let(without_commas(evidence), lambda hay: F.forall(numbers, lambda n: F.contains(hay, without_commas(n))))


def names_location(c: Column) -> Column:
    return F.rlike(text(c), F.lit("(?i)" + LOCATION))


def identifier(c: Column) -> Column:
    return F.regexp_replace(F.lower(strip(text(c))), _NO_IDENTIFIER, "")


def looks_like_table(c: Column) -> Column:
    lines = F.array_remove(F.transform(F.split(text(c), "\\r\\n|[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x85\\x{2028}\\x{2029}]"), strip), "")

    def told(x: Column) -> Column:
        return (x["n"] >= 2) & F.exists(x["head"], lambda l: F.contains(l, F.lit("|"))) & F.exists(x["head"], lambda l: F.rlike(l, F.lit("^[|]?[ \\t]*-{3,}")))

    return let(let(lines, lambda ls: F.struct(F.size(ls).alias("n"), F.slice(ls, 1, 8).alias("head"))), told)


def has_rows(c: Column) -> Column:
    """The looser table test: a bar and a newline."""
    return F.contains(text(c), F.lit("|")) & F.contains(text(c), F.lit("\n"))


def _occurrences(sample: Column, characters: str) -> Column:
    return F.length(sample) - F.length(F.translate(sample, characters, ""))


def language(c: Column, fallback: Column | None = None) -> Column:
    """en, zh or zh-Hant, from the first 4000 characters."""
    sample = strip(text(c))
    if fallback is not None:
        sample = F.when(sample == "", strip(text(fallback))).otherwise(sample)

    def told(x: Column) -> Column:
        cjk = F.length(F.regexp_replace(x, _NO_IDEOGRAPH, ""))
        latin = (cjk < 12) | (cjk / F.greatest(F.lit(1), F.length(x)) < 0.01)
        counted = F.struct(_occurrences(x, "".join(v[0] for v in VARIANTS)).alias("simple"), _occurrences(x, "".join(v[1] for v in VARIANTS)).alias("full"))
        chinese = let(counted, lambda n: F.when((n["full"] >= 3) & (n["full"] >= n["simple"] + 2), "zh-Hant").otherwise("zh"))
        return F.when(latin, "en").otherwise(chinese)

    return let(F.substring(sample, 1, 4000), told)


def service_language(c: Column) -> Column:
    """zh from 30 ideographs and 2 per cent on, else en."""

    def told(x: Column) -> Column:
        cjk = F.length(F.regexp_replace(x, _NO_IDEOGRAPH, ""))
        return F.when((cjk >= 30) & (cjk / F.greatest(F.lit(1), F.length(x)) >= 0.02), "zh").otherwise("en")

    return let(F.substring(strip(text(c)), 1, 4000), told)


def known_language(c: Column) -> Column:
    value = strip(text(c))
    return F.when(value.isin("en", "zh", "zh-Hant"), value).otherwise("en")


def one_line(c: Column, most: int) -> Column:
    """One line of at most `most` characters; a longer one ends in an ellipsis. If the start of a text makes more
    than a line, the rest can't change it and isn't collapsed."""
    cut = lambda flat: F.when(F.length(flat) <= most, flat).otherwise(F.concat(F.rtrim(F.substring(flat, 1, most - 1)), F.lit("…")))
    whole, near = text(c), 2 * most
    enough = lambda head: (F.length(head) > most) | (F.length(whole) <= near)
    return let(collapse(F.substring(whole, 1, near)), lambda head: F.when(enough(head), cut(head)).otherwise(let(collapse(whole), cut)))


def safe_name(c: Column) -> Column:
    """A name for a dataset: letters, digits, dot, dash and underscore, no separators at the ends."""
    plain = F.trim(F.regexp_replace(strip(text(c)), _UNSAFE, "_"), F.lit("._"))
    return F.coalesce(F.nullif(plain, F.lit("")), F.lit("dataset"))


def file_title(c: Column) -> Column:
    return F.regexp_replace(text(c), "\\.[^.]*$", "")


def image_targets(c: Column) -> Column:
    return F.regexp_extract_all(text(c), F.lit("!\\[([^\\]]*)\\]\\(([^)]+)\\)"), F.lit(2))


def strip_citations(c: Column) -> Column:
    plain = F.regexp_replace(text(c), "\\[([0-9]+)\\]", "")
    plain = F.regexp_replace(plain, "[ \\t]+", " ")
    plain = F.regexp_replace(plain, f"[{SPACE}]+\\n", "\n")
    return strip(F.regexp_replace(plain, f"\\n[{SPACE}]+", "\n"))


def citation_fault(c: Column, allowed: Column) -> Column:
    """First fault of a cited answer, or null. `allowed` is an array of evidence numbers."""
    uncited = f"(?:{SENTENCE_END})(?![{SPACE}]*\\[[0-9]+\\])"

    def told(s: Column) -> Column:
        cited = F.transform(F.regexp_extract_all(s, F.lit("\\[([0-9]+)\\]"), F.lit(1)), lambda x: x.cast("long"))
        unknown = lambda e: F.filter(e, lambda x: ~F.array_contains(allowed, x))
        rest = F.regexp_replace(s, "\\[[0-9]+\\]", "")
        known = let(cited, lambda e: F.when(F.size(e) == 0, "missing_citations").when(F.size(unknown(e)) > 0, F.concat(F.lit("unknown_eid:"), F.get(unknown(e), F.lit(0)).cast("string"))))
        loose = let(rest, lambda r: F.contains(r, F.lit("[")) | F.contains(r, F.lit("]")))
        shape = F.when(loose, "malformed_brackets").when(F.rlike(s, F.lit(uncited)), "missing_sentence_end_citation")
        return F.when(s == "", "empty_answer_with_citations").when(F.rlike(s, F.lit(OTHER_CITATION)), "uses_non_square_bracket_citation_mark").otherwise(F.coalesce(known, shape))

    return let(strip(text(c)), told)


def meaningful_caption(c: Column, base_name: Column, lang: str | None) -> Column:
    """Whether a caption says something: not empty, generic, a file name or a hash."""
    t = strip(text(c))
    low = collapse(F.lower(t))
    base = F.lower(text(base_name))
    generic = low.isin(*GENERIC_CAPTIONS) | F.rlike(low, F.lit("^(an?|the)\\s+(image|figure|diagram|chart|photo|screenshot|illustration|table|formula|equation)$"))
    if lang == "en":
        generic = generic | low.isin(*GENERIC_NOUNS_EN)
    if lang == "zh":
        generic = generic | t.isin(*GENERIC_NOUNS_ZH)
    lower = F.lower(t)
    stem = F.regexp_replace(F.regexp_replace(t, "^.*/", ""), "(?<=.)\\.[^.]*$", "")
    named = ((base != "") & F.contains(lower, base)) | F.rlike(lower, F.lit("\\.(png|jpe?g|webp|gif|bmp|tiff?)\\b"))
    hashed = F.rlike(stem, F.lit("^[0-9a-fA-F]{16,}$")) | F.rlike(lower, F.lit("\\b[0-9a-f]{24,}\\b"))
    enough = F.lit(True)
    if lang == "zh":
        enough = F.length(F.regexp_replace(t, "[^一-鿿]", "")) >= 2
    if lang == "en":
        enough = F.length(F.regexp_replace(lower, "[^a-z]", "")) >= 3
    return (t != "") & ~generic & ~named & ~hashed & enough


def fallback_caption(number: Column, lang: str) -> Column:
    return F.concat(F.lit("图" if lang == "zh" else "Figure "), number.cast("string"))


def alt_text(c: Column, most: int = 220) -> Column:
    """Text fit for the alt part of an image reference."""
    flat = collapse(text(c))
    return F.substring(F.regexp_replace(flat, "[\\[\\]]", ""), 1, most)


def relative_path(c: Column) -> Column:
    """Path of a URL or file reference without query, fragment and leading dots and slashes."""
    path = F.regexp_replace(strip(text(c)), "^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.regexp_replace(F.regexp_replace(path, "[?#].*$", ""), "^[./]+", "")


def mime_type(c: Column) -> Column:
    suffix = F.lower(F.regexp_extract(text(c), "\\.([^./]+)$", 1))
    return F.when(suffix.isin("jpg", "jpeg"), "image/jpeg").when(suffix == "webp", "image/webp").when(suffix == "gif", "image/gif").otherwise("image/png")


def data_url(content: Column, name: Column) -> Column:
    return F.concat(F.lit("data:"), mime_type(name), F.lit(";base64,"), F.base64(content))


def context_tokens(c: Column) -> Column:
    return F.regexp_extract_all(text(c), F.lit("[A-Za-z0-9_一-鿿]+|[^A-Za-z0-9_一-鿿\\s]"), F.lit(0))


def short_hash(content: Column) -> Column:
    """The id of a file: the first 16 hex digits of its SHA-256."""
    return F.substring(F.sha2(content, 256), 1, 16)


def hash64(c: Column) -> Column:
    """First 8 bytes of the MD5, as the same 64 bits in a long."""
    digest = F.md5(c)
    part = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    return F.shiftleft(part(1), 32).bitwiseOR(part(9))
