"""The six report kinds: table layout, fixed request parameters and output schema."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Row-label attributes and the columns they fill.
FULL_LABEL = {"media_type": "media_type", "company_id": "web_id", "parent_company_id": "parent_id"}
ID_LABEL = {"company_id": "web_id"}


@dataclass(frozen=True)
class Layout:
    """How the cells of a data row are read.

    ``key_cells`` name the leading cells that are keys; ``top_shift`` is how many cells the upper header row lacks
    at its front; ``cells`` and ``top_cells`` are the exact counts the layout applies to (None: any).
    """

    key_cells: tuple[str, ...] = ()
    top_shift: int = 0
    cells: int | None = None
    top_cells: int | None = None


@dataclass(frozen=True)
class ReportSpec:
    """One report kind.

    ``ragged`` says what happens to a row whose width differs from the expected one: ``drop`` rejects it, ``pad``
    fills short rows with null and cuts long ones, ``strict`` cuts long rows and rejects short ones.
    ``top`` names the column the upper header row fills; labels in ``top_blanks`` count as null there.
    ``width_from`` takes the expected width from the header or, for compatibility, from the first data row.
    """

    name: str
    header_rows: int
    label: str
    attributes: dict[str, str]
    layouts: tuple[Layout, ...]
    ragged: str
    schema: T.StructType
    top: str | None = None
    top_blanks: tuple[str, ...] = ()
    constants: tuple[tuple[str, str], ...] = ()
    parameters: tuple[tuple[str, int], ...] = ()
    measures: tuple[int, ...] = ()
    options: tuple[str, ...] = ()
    has_target: bool = False
    width_from: str = "header"

    def with_width_from(self, source: str) -> "ReportSpec":
        return replace(self, width_from=source)

    def without_category_columns(self) -> "ReportSpec":
        """The report as asked for without its category columns: no key cells lead the rows."""
        plain = tuple(dict.fromkeys(replace(x, key_cells=(), cells=None if x.cells is None else x.cells - len(x.key_cells)) for x in self.layouts))
        return replace(self, layouts=plain, options=tuple(o for o in self.options if o != "includeCategoryColumn"))

    def with_layouts(self, *layouts: Layout) -> "ReportSpec":
        return replace(self, layouts=layouts)


def _schema(columns: str) -> T.StructType:
    kinds = {"float": T.FloatType(), "int": T.IntegerType(), "string": T.StringType()}
    fields = (c.split(":") for c in columns.split())
    return T.StructType([T.StructField(f[0], kinds[f[1] if len(f) > 1 else "string"]) for f in fields])


# Output columns, request parameters, measure ids and labels of the reports.
DESKTOP = ReportSpec(
    name="desktop",
    header_rows=1,
    label="media",
    attributes=FULL_LABEL,
    layouts=(Layout(key_cells=("category", "attribute")),),
    ragged="drop",
    schema=_schema(
        "media media_type company_id parent_company_id category attribute metric metric_id metric_value:float "
        "timeframe month year:int report_type categories"
    ),
    constants=(("report_type", "Desktop Only"),),
    parameters=(("geo", 840), ("loc", 0), ("targetType", 0), ("targetGroup", 15), ("dataSource", 1)),
    measures=(1, 2, 3, 5, 6, 7, 8, 9, 10, 11, 12, 14, 15, 16, 70, 71, 143, 144, 145, 146, 274),
    options=("includeCategoryColumn",),
)

LOCAL_MARKET = ReportSpec(
    name="local_market",
    header_rows=1,
    label="media",
    attributes=FULL_LABEL,
    layouts=(Layout(),),
    ragged="pad",
    schema=_schema(
        "media media_type company_id parent_company_id metric metric_id metric_value:float region state region_id "
        "timeframe month year:int report_type categories"
    ),
    constants=(("report_type", "Local Market Single Region"),),
    parameters=(("geo", 840), ("loc", 0), ("targetType", 0), ("targetGroup", 15), ("dataSource", 1)),
    measures=DESKTOP.measures,
)

# A table whose widths are neither of the known ones holds no readable rows: they are rejected as unknown_layout.
MULTI_PLATFORM = ReportSpec(
    name="multi_platform",
    header_rows=2,
    label="media",
    attributes=FULL_LABEL,
    layouts=(
        Layout(key_cells=("category",), top_shift=1, cells=46, top_cells=45),
        Layout(key_cells=("category",), cells=46, top_cells=46),
        Layout(key_cells=("category", "attribute"), cells=47),
    ),
    ragged="drop",
    top="platform",
    top_blanks=("Category", "Attribute"),
    schema=_schema(
        "media media_type company_id parent_company_id category attribute metric metric_id metric_value:float "
        "platform month year:int report_type categories"
    ),
    constants=(("report_type", "Multi-platform Only"),),
    parameters=(
        ("geo", 840), ("timeType", 1), ("universeTypeId", 4), ("targetType", 0), ("targetGroup", 15),
        ("dataSource", 25),
    ),
    measures=(
        276, 277, 278, 279, 280, 281, 282, 283, 284, 285, 286, 287, 288, 289, 290, 291, 292, 293, 294, 295, 296, 297,
        298, 299, 300, 301, 302, 303, 304, 305, 306, 307, 308, 309, 310, 311, 312, 313, 314, 315, 316, 317, 318, 319,
        386,
    ),
    options=("includeCategoryColumn",),
)

MOBILE = ReportSpec(
    name="mobile_web_and_app",
    header_rows=2,
    label="media",
    attributes=FULL_LABEL,
    layouts=(Layout(),),
    ragged="strict",
    top="platform",
    schema=_schema(
        "media media_type company_id parent_company_id metric metric_id metric_value:float platform month year:int "
        "report_type categories"
    ),
    constants=(("report_type", "Mobile Web & App"),),
    parameters=(
        ("geo", 840), ("timeType", 1), ("platform", 1), ("accessMethod", 20), ("targetType", 0), ("targetGroup", 15),
        ("universeTypeId", 1),
    ),
    measures=(1, 2, 3, 6, 7, 9, 10, 11, 12, 70, 143, 144, 145, 651),
)

CROSS_VISITING = ReportSpec(
    name="cross_visiting",
    header_rows=2,
    label="benchmark_media",
    attributes={"benchmark_media_id": "web_id"},
    layouts=(Layout(key_cells=("media_target_audience",)),),
    ragged="drop",
    top="comparison_media",
    has_target=True,
    schema=_schema(
        "benchmark_media benchmark_media_id demographic comparison_media media_target_audience "
        "per_benchmark_media_visit_comparison_media:float per_comparision_media_visit_benchmark_media:float "
        "index:float shared_audience_000:float month year:int platform timeframe"
    ),
    constants=(("platform", "Desktop"),),
    parameters=(("geo", 840), ("targetType", 0), ("mediaRowType", 0)),
    measures=(52, 53, 54, 228),
)

AUDIENCE_DUPLICATION = ReportSpec(
    name="audience_duplication",
    header_rows=1,
    label="benchmark_media",
    attributes={"benchmark_media_id": "web_id"},
    layouts=(Layout(),),
    ragged="drop",
    has_target=True,
    schema=_schema(
        "benchmark_media benchmark_media_id metrics metric_id benchmark_metric_value:float demographic "
        "duplicated_all_sites:float unduplicated:float comparision_media month year:int platform timeframe"
    ),
    constants=(("platform", "Desktop"),),
    parameters=(("geo", 840), ("targetType", 0)),
    measures=(1, 2, 3, 9),
)

REPORTS = {
    s.name: s for s in (DESKTOP, LOCAL_MARKET, MULTI_PLATFORM, MOBILE, CROSS_VISITING, AUDIENCE_DUPLICATION)
}

# The measure labels of the pair reports.
CROSS_VISITING_METRICS = {
    "% Horizontal": "per_benchmark_media_visit_comparison_media",
    "% Vertical": "per_comparision_media_visit_benchmark_media",
    "Index": "index",
    "Shared Audience (000)": "shared_audience_000",
}
CROSS_VISITING_MEASURES = {52: "% Vertical", 53: "% Horizontal", 54: "Index", 228: "Shared Audience (000)"}
DUPLICATION_MEASURES = {1: "Total Unique Visitors (000)", 2: "Total Minutes (MM)", 3: "Total Pages Viewed (MM)", 9: "% Reach"}
DUPLICATION_SUMMARIES = ("duplicated_2_or_more_sites", "duplicated_all_sites", "unduplicated")

# Corrected spellings for readers who do not want the contract's own.
CORRECTED_NAMES = {
    "per_comparision_media_visit_benchmark_media": "per_comparison_media_visit_benchmark_media",
    "comparision_media": "comparison_media",
}
