"""Property tests for the header rules (pure Python, no Spark)."""

import csv
import io

from hypothesis import given, settings
from hypothesis import strategies as st

from cubelake.sources.cube_csv import parse_header, strip_junk_prefix, unique_names

NAMES = st.lists(st.sampled_from(["REF_DATE", "GEO", "Symbol", "Symbol.1", "VALUE", "A", "A.1", "A.2"]), max_size=12)


@given(NAMES)
@settings(max_examples=200)
def test_unique_names_properties(names):
    out = unique_names(names)
    assert len(out) == len(names)
    assert len(set(out)) == len(out)
    for i, (original, renamed) in enumerate(zip(names, out)):
        # a name keeps itself when it is still free at its turn, else gets a suffix
        if original not in out[:i]:
            assert renamed == original
        else:
            assert renamed.startswith(original + ".")


@given(
    st.lists(st.text(alphabet='abcXYZ _,"', min_size=1, max_size=6), min_size=1, max_size=6),
    st.sampled_from(["", "\ufeff", "\u00ef\u00bb\u00bf", "\u00a0\u00a0"]),
)
@settings(max_examples=200)
def test_parse_header_round_trip(fields, junk):
    buf = io.StringIO()
    csv.writer(buf, quoting=csv.QUOTE_MINIMAL).writerow(fields)
    line = junk + buf.getvalue().rstrip("\r\n")
    assert strip_junk_prefix(line) == line[len(junk):]
    assert parse_header(line) == unique_names(fields)
