"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from .divergence import OP12_SQL, op12_divergence
from .language import op2_language
from .lines import OP4_SQL, op4_line_dedup
from .mixing import op7_mixing
from .ogg import op5_media_columns
from .near import op9_near_dedup
from .packing import op3_packing
from .pages import op8_html_extraction
from .personal import op10_personal_data
from .quality import op6_quality_outliers
from .resample import OP13_SQL, op13_resample
from .simhash import op11_simhash
from .suffixes import op1_suffix_dedup

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_language": op2_language,
    "op3_packing": op3_packing,
    "op4_line_dedup": op4_line_dedup,
    "op5_media_columns": op5_media_columns,
    "op6_quality_outliers": op6_quality_outliers,
    "op7_mixing": op7_mixing,
    "op8_html_extraction": op8_html_extraction,
    "op9_near_dedup": op9_near_dedup,
    "op10_personal_data": op10_personal_data,
    "op11_simhash": op11_simhash,
    "op12_divergence": op12_divergence,
    "op13_resample": op13_resample,
}
ORACLE_SQL = {"op4_line_dedup": OP4_SQL, "op12_divergence": OP12_SQL, "op13_resample": OP13_SQL}
