"""The engine's commands as functions, by group."""

from __future__ import annotations

from factloom.functions.dates import normalize, normalize_all, normalize_one
from factloom.functions.text import sentences as split_sentences
from factloom.functions.text import tokens as tokenize
from factloom.operators.annotation import form, gold, majority, units, unpivot
from factloom.operators.extraction import many_to_many, sentence_rows, verbs_per_sentence
from factloom.operators.frames import assign_elements, first_frame, prioritized, sentence_scores
from factloom.operators.learning import dummy, f1, fit_bank, knn, model_selection, predict_bank, to_elements, window_features
from factloom.operators.labelling import label
from factloom.operators.linking import link as entity_linking
from factloom.operators.ranking import harmonic as rank_verbs
from factloom.operators.ranking import frame_ranking, lemma_popularity, lemma_scores, lemma_tokens, popularity, tfidf_rank
from factloom.operators.sampling import balanced as balanced_extract
from factloom.operators.sampling import one_of, totals
from factloom.operators.serialise import serialise, url_subjects
from factloom.operators.statements import disambiguate, from_fields, monuments, qualifiers, statement
from factloom.operators.stats import counters as about_biographies_count
from factloom.operators.stats import length_histogram as about_biographies_length
from factloom.operators.stats import source_counts as about_sources
from factloom.operators.tagging import clause_extract, grammar_extract
from factloom.operators.tagging import tagged as pos_tag
from factloom.sources.files import corpus, preprocess, read_csv, read_items, read_tar
from factloom.sources.sites import crawled

COMMANDS = {
    "commons": (tokenize, pos_tag, entity_linking, split_sentences, statement, serialise, url_subjects), "corpus_analysis": (rank_verbs, verbs_per_sentence, about_sources, about_biographies_count, about_biographies_length, tfidf_rank, popularity, lemma_tokens, lemma_scores, lemma_popularity, frame_ranking),
    "extraction": (from_fields, sentence_rows, many_to_many, one_of, grammar_extract, clause_extract, balanced_extract, totals), "rule_based": (label, first_frame, assign_elements, prioritized, sentence_scores, normalize, normalize_all, normalize_one),
    "classification": (model_selection, fit_bank, predict_bank, to_elements, dummy, window_features, knn, f1), "annotation": (units, unpivot, form, majority, gold), "web_sources": (preprocess, corpus, read_items, read_tar, read_csv, crawled),
    "side_projects": (monuments, qualifiers, disambiguate),
}
