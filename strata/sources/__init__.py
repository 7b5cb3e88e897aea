"""Sources: the contract CSV reader/writer and layer reader (``files``), file operations on any file system
(``fs``) and the raw feed derived from ``orders`` (``feed``)."""
