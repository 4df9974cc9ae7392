"""Fixed values.

Everything in this module is a constant that results depend on: alphabets,
lookup tables, text patterns and message formats.  Nothing here is computed.
"""

# The characters that count as whitespace when cells are trimmed
# and words are split.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same alphabet as the inside of a Java character class, under flag (?U).
WHITESPACE_CLASS = r"\s\x1c-\x1f"
# Line terminators recognised when one text value holds a whole table.
LINE_BREAK = r"\r\n|[\x0a-\x0d\x1c-\x1e\x{85}\x{2028}\x{2029}]"

# Number spellings accepted as cells.  Digit runs are plain classes,
# because a matcher recurses once per repeated group; an underscore that is not
# between two digits is looked for separately.
DIGITS = r"[0-9][0-9_]*"
STRAY_UNDERSCORE = r"(?:\A|[^0-9])_|_(?:[^0-9]|\z)"
INT_CELL = rf"[+-]?{DIGITS}"
FLOAT_CELL = (
    rf"[+-]?(?:(?:{DIGITS}(?:\.[0-9_]*)?|\.{DIGITS})(?:[eE][+-]?{DIGITS})?"
    r"|(?i:inf|infinity|nan))"
)

# Spellings of a missing categorical cell (besides NULL).
MISSING_LITERALS = ("", "NA", "N/A", "null", "NULL", "-", "?")

# Access-log line.  Groups: 1 ip, 2 timestamp, 3 method, 4 path,
# 5 status, 6 bytes, 7 milliseconds.  Anchored at the start only; {ws} stands for
# the whitespace class.
LOG_LINE = (
    r"([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+) "
    r"[^{ws}]+ [^{ws}]+ "
    r"\[([^\]]+)\] "
    r'"([A-Z]+) ([^{ws}]+) [^"]*" '
    r"([0-9]{3}) "
    r"([0-9]+|-) "
    r"([0-9]+)"
)
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"

# Forecast cell 'high/low/sky' and the sky legend.
FORECAST_CELL = r"-?[0-9]{1,3}/-?[0-9]{1,3}/[a-z]{1,2}"
SKY = {
    "s": "sunny",
    "pc": "partly cloudy",
    "c": "cloudy",
    "sh": "showers",
    "t": "t-storms",
    "r": "rain",
    "sn": "snow",
    "f": "flurries",
    "i": "ice",
    "w": "windy",
    "rs": "rain/snow",
}

# Sentence enders, paragraph break, share of a chunk after which a
# sentence end may close it; {ws} as above.
SENTENCE_MARKS = (".", "!", "?")
SENTENCE_END = "[.!?]"
PARAGRAPH_BREAK = r"\n[{ws}]*\n"
CHUNK_FLOOR = 0.67

# Class names and divisors of the multi-branch number label.
NUMBER_LABELS = ("num", "Fizz", "Buzz", "FizzBuzz")

# Message formats.
REJECT_MESSAGE = "line %d: missing %s -> skipped"
DRIFT_MESSAGES = {
    "strict_completeness": "completeness %.3f%% < 100%%",
    "strict_integral": "only %.3f%% of data is Integral",
    "tuned_completeness": "completeness %.1f%%",
    "tuned_integral": "only %.1f%% of data is Integral",
    "non_negative": "is_non_negative violated",
    "mean_shift": "mean moved %.0f%% (%.1f -> %.1f)",
}
