"""Training-data operators: de-duplication, decontamination, language
identification, licence scans, nearest neighbours, LM scoring, URL filters and
source mixing.  Nothing else in the library imports this subpackage."""
