"""Text expressions. Every function takes and returns Columns; nothing here runs Python per row."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley import constants as C

# Java's Unicode \s lacks the four separators U+001C..U+001F that count as white space here.
_SPACE = r"[\s\x1c-\x1f]"
_WORD = r"[^\s\x1c-\x1f]"
_CUE = "(?iuU)" + C.REQUEST_CUE.replace(r"\s", _SPACE)
FILE_NAME = r"^([^\n]+)_channel([12])\.wav\z"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def _once(value, use) -> Column:
    """`use(value)` with the value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def strip(c) -> Column:
    """Remove all Unicode white space at both ends."""
    return F.btrim(_col(c), F.lit(C.WHITESPACE))


def is_blank(c) -> Column:
    """Null, empty, or white space only."""
    return strip(F.coalesce(_col(c), F.lit(""))) == ""


def not_blank(c) -> Column:
    return ~is_blank(c)


def call_id(file_name) -> Column:
    """Call id of a channel file name; '' when the name is malformed or null."""
    return F.regexp_extract(F.coalesce(_col(file_name), F.lit("")), FILE_NAME, 1)


def channel(file_name) -> Column:
    """Channel number of a channel file name; null when the name is malformed."""
    digits = F.regexp_extract(F.coalesce(_col(file_name), F.lit("")), FILE_NAME, 2)
    return F.when(digits != "", digits.cast("int"))


def display_value(c, limit=C.DISPLAY_CHARS) -> Column:
    """Value as shown in a preview: long text is cut and marked."""
    c = _col(c)
    return F.when(
        F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(C.CUT_MARK))
    ).otherwise(c)


def one_line(c, limit) -> Column:
    """First `limit` characters with line feeds shown as blanks."""
    return F.substring(F.replace(_col(c), F.lit("\n"), F.lit(" ")), 1, limit)


def lines(c) -> Column:
    """Array of the non-blank lines of a text."""
    return F.filter(F.split(_col(c), r"\r?\n"), lambda x: not_blank(x))


# ---- tokens, n-grams, chunks ----


def tokens(c) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(r"([\p{L}\p{N}_]{2,})"), F.lit(1))


def without_stop_words(token_array, words=None) -> Column:
    words = C.stop_words() if words is None else list(words)
    return F.filter(_col(token_array), lambda t: ~t.isin(words))


def unigrams_and_bigrams(token_array) -> Column:
    """The tokens followed by every pair of neighbours."""

    def both(a):
        pairs = F.zip_with(
            a, F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))), lambda x, y: F.concat(x, F.lit(" "), y)
        )
        # The last token has no right neighbour: its pair is null.
        return F.concat(a, F.slice(pairs, 1, F.greatest(F.size(a) - 1, F.lit(0))))

    return _once(_col(token_array), both)


def clustering_terms(c, words=None) -> Column:
    """Stop words go first, so a pair may bridge a removed word."""
    return unigrams_and_bigrams(without_stop_words(tokens(c), words))


def classifier_terms(c) -> Column:
    return unigrams_and_bigrams(tokens(c))


def words(c) -> Column:
    """White-space separated words: the default tokenizer of the token-budget functions."""
    return F.filter(F.split(_col(c), "(?U)" + _SPACE + "+"), lambda w: w != "")


def chunks(token_array, size) -> Column:
    """Consecutive slices of at most `size` tokens."""

    def cut(a):
        starts = F.when(
            F.size(a) > 0, F.sequence(F.lit(1), F.size(a), F.lit(size))
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.slice(a, i, F.lit(size)))

    return _once(_col(token_array), cut)


# ---- request cue, focus window, excerpt ----


def has_request_cue(c) -> Column:
    return _col(c).rlike(_CUE)


def focus_text(c, before=C.FOCUS_WORDS_BEFORE, after=C.FOCUS_WORDS_AFTER) -> Column:
    """Window around the first request cue; the whole text when there is none.

    The words before the cue are read off the reversed prefix, so the pattern is anchored and
    looks at a few words only, however long the text is.
    """
    x = _col(c)
    reach = f"(?U)^({_WORD}*(?:{_SPACE}+{_WORD}+){{0,{before}}})"
    ahead = f"(?U)^({_WORD}+(?:{_SPACE}+{_WORD}+){{0,{after - 1}}})"

    def window(parts):
        prefix = parts[0]

        def around(back):
            # The words before the cue, and how much of them belongs to the word the cue starts in.
            broken = F.length(F.regexp_extract(back, f"(?U)^({_WORD}*)", 1))
            lead = F.regexp_replace(F.reverse(back), f"(?sU)^.*[.!?]{_SPACE}+", "")
            rest = F.substr(x, F.length(prefix) - broken + 1)
            return F.concat(
                F.substr(lead, F.lit(1), F.length(lead) - broken), F.regexp_extract(rest, ahead, 1)
            )

        back = F.regexp_extract(F.reverse(prefix), reach, 1)
        return F.when(F.size(parts) < 2, x).otherwise(_once(back, around))

    return _once(F.split(x, _CUE, 2), window)


def excerpt(focus, limit=C.EXCERPT_CHARS, min_sentence=C.EXCERPT_MIN_SENTENCE) -> Column:
    """First sentence of a focus window when it is long enough, cut to `limit` characters."""
    text = strip(focus)
    end = f"[.!?](?:{_SPACE}|\\z)"
    sentence = F.split(text, "(?U)" + end, 2)[0]
    found = text.rlike("(?U)" + end)
    # One more character for the mark and one for the white space unless the text ends there.
    end_position = F.least(F.length(sentence) + 2, F.length(text))
    cut = F.when(
        found & (end_position >= min_sentence), F.substr(text, F.lit(1), F.length(sentence) + 1)
    ).otherwise(text)
    return strip(F.substring(cut, 1, limit))


def fallback_statement(c) -> Column:
    return excerpt(focus_text(c))


# ---- prompt and statement ----


def build_prompt(c) -> Column:
    return F.concat(F.lit(C.PROMPT_HEAD), _col(c), F.lit(C.PROMPT_TAIL))


def fixed_prompt_tokens() -> int:
    """Words of the empty prompt plus one end mark."""
    return len((C.PROMPT_HEAD + C.PROMPT_TAIL).split()) + 1


def budgeted_prompt(text, focus, limit=C.MAX_INPUT_TOKENS):
    """(prompt, truncated) of a focus window under a budget of white-space tokens."""
    available = limit - fixed_prompt_tokens() - C.TOKEN_MARGIN
    if available <= 0:
        raise ValueError("the token limit leaves no room for the text")
    text, focus = _col(text), _col(focus)
    pieces = words(focus)
    truncated = (F.length(focus) < F.length(text)) | (F.size(pieces) > available)
    kept = F.array_join(F.slice(pieces, 1, available), " ")
    return build_prompt(F.when(truncated, kept).otherwise(focus)), truncated


def normalize_statement(c) -> Column:
    """Tidy a generated statement; '' when it says nothing."""
    value = strip(F.regexp_replace(F.coalesce(_col(c), F.lit("")), f"(?U){_SPACE}+", " "))
    value = strip(
        F.regexp_replace(value, f"(?iU)^issue(?: statement)?{_SPACE}*:{_SPACE}*", "")
    )
    lowered = F.lower(value)
    plain = strip(F.regexp_replace(lowered, "[^a-z0-9']+", " "))
    found = F.transform(
        F.regexp_extract_all(value, F.lit("([A-Za-z]+(?:'[A-Za-z]+)?)"), F.lit(1)), F.lower
    )
    junk = (
        lowered.isin(*C.EMPTY_STATEMENTS)
        | value.rlike(f"(?iU)^{C.HESITATION}\\z")
        | plain.isin(*C.GENERIC_STATEMENTS)
        | plain.contains(C.GENERIC_PHRASE)
        | (F.size(found) < 3)
        | (F.size(F.array_distinct(found)) == 1)
        | ~F.exists(found, lambda w: (F.length(w) > 1) & ~w.isin(*C.NUMBER_WORDS))
        | value.rlike(f"(?U)^[A-Z]{{2,5}}{_SPACE}*[- ]*\\d")
    )
    return F.when(junk, F.lit("")).otherwise(value)
