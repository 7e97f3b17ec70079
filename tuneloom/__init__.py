"""Prepare text datasets for model fine-tuning with Spark."""

from .operators.contracts import as_cells, contract_report, union_cells
from .operators.deliver import (
    dataset_cards,
    deliver,
    publish,
    rescan,
    write_cards,
    write_checked,
    write_snappy,
)
from .operators.generate import augment, generate, generate_resumed
from .operators.ledger import (
    completed,
    failed,
    ledger_get,
    ledger_read,
    ledger_read_json,
    ledger_save,
    ledger_upsert,
    ledger_write,
    provenance,
    roll_up,
    run_tally,
    select_targets,
    skip_completed,
    status_board,
)
from .operators.quality import quality_counts, quality_report, report_long, report_text
from .operators.select import (
    drop_blank_rows,
    filter_metrics,
    head,
    keep_columns,
    missing_columns,
    preview,
    sample_exact,
    select_rows,
    shape,
)
from .plans.recipes import (
    RECIPES,
    Recipe,
    preview_dataset,
    preview_shape,
    recipe_frame,
    republish,
    revalidate,
    run_recipe,
    run_registry,
)
from .sources.archives import archive_records, read_archives, scan_archives
from .sources.listing import list_files, pick_files
from .sources.readers import DatasetReadError, read_dataset, read_file, read_first_available, read_head
from .sources.registry import read_registry, registry_frame
from .streaming.arrivals import deliver_arrivals, prepare_rows, read_arrivals

__version__ = "0.1.0"

__all__ = [name for name in dir() if not name.startswith("_")]
