from tidewatch.sources.clusters import Clustering, clustering_of, write_clustered
from tidewatch.sources.extracts import read_extract, read_extracts
from tidewatch.sources.releases import Folder, Releases
from tidewatch.sources.schemas import RAW
from tidewatch.sources.tables import Copies, shared_folder, write_once, write_table

__all__ = [
    *("RAW", "Copies", "Folder", "Releases", "read_extract", "read_extracts"),
    *("Clustering", "clustering_of", "write_clustered"),
    *("shared_folder", "write_once", "write_table"),
]
