"""Writers: delimited files, text export, previews and reports."""
