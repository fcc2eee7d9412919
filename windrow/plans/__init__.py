from windrow.plans.batch import match_batsman_runs, outs_by_player_and_kind
from windrow.plans.streams import messages_to_window_files, records_to_window_files

__all__ = [
    "match_batsman_runs",
    "messages_to_window_files",
    "outs_by_player_and_kind",
    "records_to_window_files",
]
