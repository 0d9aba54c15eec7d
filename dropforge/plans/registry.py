"""Named views: each is a builder over sources and other views, composed into one lazy plan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from dropforge.functions.calendar import reference_date
from dropforge.plans.constants import Cutoffs

Builder = Callable[["Views"], DataFrame]

VIEWS: dict[str, Builder] = {}
NOT_THERE = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def view(*names: str) -> Callable[[Builder], Builder]:
    def register(builder: Builder) -> Builder:
        for name in names:
            VIEWS[name] = builder
        return builder

    return register


@dataclass
class Views:
    """Builds views over the tables ``read`` resolves, as of one run date.

    ``fixed`` outputs the columns two views lose to a missing comma; ``lenient`` turns impossible dates into
    nulls instead of failing; ``overseas_departments`` takes three characters of overseas communes wherever a
    department is cut out of a commune code. ``blank_codes=False`` leaves targets and missions without a facility
    code out of their join: landed nulls are blank texts, so by default every such target meets every such mission.
    """

    read: Callable[[str], DataFrame]
    today: str | date | None = None
    cutoffs: Cutoffs = field(default_factory=Cutoffs)
    fixed: bool = False
    lenient: bool = False
    overseas_departments: bool = False
    blank_codes: bool = True
    _built: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self.today = reference_date(self.today)

    def source(self, table: str) -> DataFrame:
        return self.read(table)

    def view(self, name: str) -> DataFrame:
        """The view as a DataFrame; built once, so that a plan that uses it twice can share its exchanges."""
        if name not in self._built:
            self._built[name] = VIEWS[name](self)
        return self._built[name]

    def keep(self, store, *names: str) -> None:
        """Write views to ``store`` and go on from the tables; for dimensions that many views read.

        Views built from now on read the table, whose size is known when their joins are planned.
        """
        for name in names:
            store.save(self.view(name), name)
            self._built[name] = store.read(name)

    def publish(self, *names: str, prefix: str = "") -> list[str]:
        """Register views as temp views; by default all whose tables are there (a drop of undeclared columns may never have come)."""
        out = []
        for name in names or VIEWS:
            try:
                built = self.view(name)
            except AnalysisException as e:
                if names or e.getCondition() not in NOT_THERE:
                    raise
                continue
            built.createOrReplaceTempView(prefix + name)
            out.append(prefix + name)
        return out
