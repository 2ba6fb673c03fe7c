"""Character classes shared by the expressions."""

from __future__ import annotations

# Unicode white space, as Python's str.strip() and \\s see it: inside a class under the U flag,
# and spelled out for trimming.
SPACE = r"\s\x1C-\x1F"
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACES = f"(?U:[{SPACE}]+)"
ANY_SPACE = f"(?U:[{SPACE}]*)"
WORD = f"(?U:[^{SPACE}]+)"
# Chinese characters, and names that may hold a middle dot.
CJK = r"\x{4e00}-\x{9fa5}"
CJK_NAME = f"[{CJK}·]+"
RUN = f"[{CJK}]+|(?U:[^{CJK}{SPACE}]+)"

# Kept classes of the two text cleaners, and a Latin one for European text.
KEEP_MIXED = f"{CJK}a-zA-Z0-9"
KEEP_CJK = CJK
KEEP_LATIN = r"a-zA-Z0-9\x{00C0}-\x{024F}"

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
YEAR = r"(\p{Nd}{4})"
RUNTIME = f"(\\p{{Nd}}+){ANY_SPACE}分钟"
IMDB = f"(?i)IMDb:{ANY_SPACE}({WORD})"
DURATION = f"片长[:：]?{ANY_SPACE}([0-9]+分钟)"
