"""Domains: the keywords that name them, and the questions asked of their texts."""

from __future__ import annotations

#: Domain -> keywords; in declared order, which settles ties. Operators take another table as a parameter. Texts are lower-cased before they are searched, so
#: keywords with capitals are never found in them.
KEYWORDS: dict[str, tuple[str, ...]] = {
    "neuroscience": (
        "neural", "brain", "cognitive", "neuron", "synapse", "computational", "cortex", "hippocampus",
        "plasticity", "neurotransmitter", "consciousness", "perception", "memory", "learning", "behavior", "neurological",
        "cerebral", "dendrite", "axon", "dopamine", "serotonin", "neuroplasticity", "cognition", "neural network",
        "brain imaging", "fMRI", "EEG", "neuropsychology",
    ),
    "physics": (
        "quantum", "field", "particle", "wave", "energy", "force", "relativity", "thermodynamics",
        "electromagnetic", "mechanics", "entropy", "cosmology", "universe", "spacetime", "gravity", "photon",
        "electron", "atom", "nuclear", "string theory", "dark matter", "black hole", "big bang", "physics",
        "theoretical physics", "experimental", "statistical mechanics", "optics",
    ),
    "mathematics": (
        "theorem", "proof", "equation", "algorithm", "logic", "function", "derivative", "integral",
        "matrix", "topology", "geometry", "calculus", "algebra", "analysis", "probability", "statistics",
        "number theory", "differential", "mathematical", "computation", "set theory", "graph theory", "combinatorics", "optimization",
        "linear algebra", "abstract algebra",
    ),
    "computer_science": (
        "algorithm", "computation", "data", "programming", "artificial", "database", "network", "security",
        "software", "hardware", "computing", "machine learning", "AI", "artificial intelligence", "cybernetics", "information theory",
        "digital", "computer", "processor", "memory", "operating system", "distributed", "parallel", "complexity theory",
    ),
    "philosophy": (
        "consciousness", "knowledge", "reality", "existence", "ethics", "logic", "metaphysics", "epistemology",
        "ontology", "phenomenology", "philosophy", "philosophical", "moral", "virtue", "truth", "meaning",
        "being", "mind", "soul", "free will", "determinism", "rationalism", "empiricism", "existentialism",
        "pragmatism", "idealism", "materialism", "dualism",
    ),
    "biography": (
        "life", "born", "career", "achievement", "contribution", "influence", "biography", "autobiography",
        "memoir", "legacy", "childhood", "education", "family", "personal", "death", "accomplishment",
        "pioneer", "revolutionary", "inventor", "scientist", "philosopher", "mathematician", "physicist", "journey",
        "story", "experiences", "letters", "correspondence",
    ),
    "law": (
        "legal", "court", "statute", "case", "jurisdiction", "precedent", "constitutional", "contract",
        "tort", "criminal", "civil", "justice", "law", "lawyer", "attorney", "judge",
        "trial", "evidence", "witness", "litigation", "appeal", "Supreme Court", "federal", "state law",
        "regulation", "compliance", "legal system", "jurisprudence",
    ),
    "economics": (
        "economic", "economy", "market", "trade", "money", "finance", "banking", "investment",
        "capitalism", "socialism", "wealth", "poverty", "inequality", "GDP", "inflation", "recession",
        "supply", "demand", "price", "cost", "profit", "business", "industry", "labor",
        "employment", "game theory",
    ),
    "literature": (
        "novel", "story", "narrative", "character", "plot", "theme", "literary", "author",
        "writer", "poetry", "poem", "prose", "fiction", "non-fiction", "criticism", "analysis",
        "interpretation", "symbolism", "metaphor", "style", "genre", "classic", "contemporary", "modernism",
        "postmodern",
    ),
    "psychology": (
        "psychological", "behavior", "mental", "emotion", "personality", "therapy", "psychoanalysis", "cognitive psychology",
        "social psychology", "development", "learning", "memory", "perception", "motivation", "unconscious", "conscious",
        "psyche", "psychiatry", "clinical", "experimental psychology",
    ),
    "history": (
        "historical", "history", "ancient", "medieval", "modern", "contemporary", "civilization", "culture",
        "society", "political", "revolution", "war", "empire", "dynasty", "century", "era",
        "period", "timeline", "chronology", "archaeological", "primary source", "secondary source", "historiography",
    ),
    "science_general": (
        "scientific", "research", "experiment", "hypothesis", "theory", "evidence", "method", "empirical",
        "observation", "measurement", "data", "analysis", "discovery", "innovation", "technology", "laboratory",
        "peer review", "publication", "journal", "academic", "scholar", "study",
    ),
    "astronomy": (
        "astronomical", "telescope", "star", "planet", "galaxy", "solar system", "constellation", "nebula",
        "comet", "asteroid", "spacecraft", "NASA", "observatory", "celestial", "cosmic", "interstellar",
        "planetary", "astrophysics", "cosmology", "universe", "space exploration",
    ),
    "biology": (
        "biological", "evolution", "species", "organism", "cell", "DNA", "gene", "genetics",
        "natural selection", "adaptation", "ecosystem", "ecology", "molecular biology", "biochemistry", "physiology", "anatomy",
        "taxonomy", "biodiversity", "population", "habitat", "reproduction", "inheritance",
    ),
    "chemistry": (
        "chemical", "molecule", "atom", "element", "compound", "reaction", "bond", "catalyst",
        "organic chemistry", "inorganic chemistry", "physical chemistry", "analytical chemistry", "laboratory", "synthesis", "periodic table", "ion",
        "acid", "base", "solution", "crystallography",
    ),
}

#: For texts of every domain.
GENERAL = (
    "What are the central arguments of {label}?",
    "How do the main ideas of {label}connect to wider themes?",
    "How would you analyse the concepts in {label}?",
    "What evidence does {label}give?",
    "What follows in theory and practice from {label}?",
    "What does {label}offer to other fields?",
    "What does {label}leave open for later study?",
    "Which viewpoints does {label}set against each other?",
    "Which methods does {label}name or imply?",
    "Which common belief does {label}dispute?",
)

TEMPLATES: dict[str, tuple[str, ...]] = {
    "neuroscience": (
        "Which brain functions does {label}touch on?",
        "What neural mechanism does {label}set out?",
        "Which pathways does {label}trace?",
        "What does {label}say about thought and behaviour?",
        "What does {label}add to the study of awareness?",
        "How does {label}bear on learning and change in the brain?",
        "How does structure serve function in {label}?",
        "Which models of the brain fit {label}?",
    ),
    "physics": (
        "Which physical laws does {label}use?",
        "How does {label}connect to quantum or relativistic ideas?",
        "What formal framework underlies {label}?",
        "Which predictions of {label}can be tested?",
        "What does {label}tell us of the universe?",
        "Which symmetries or conserved quantities appear in {label}?",
        "How do theory and observation meet in {label}?",
        "What does {label}mean for particles or the cosmos?",
    ),
    "mathematics": (
        "How would you prove what {label}claims?",
        "Why does the result in {label}matter?",
        "Where can the mathematics of {label}be applied?",
        "What are the steps of the reasoning in {label}?",
        "What does {label}assume?",
        "Which other branches of mathematics does {label}touch?",
        "What picture helps to understand {label}?",
        "How would one compute what {label}describes?",
    ),
    "computer_science": (
        "Which algorithms and data structures does {label}describe?",
        "How costly is the computation in {label}?",
        "Which theory and which uses does {label}have?",
        "What does {label}say about learning machines?",
        "How does {label}treat information?",
        "What does {label}mean for security and privacy?",
        "Which engineering principles does {label}follow?",
        "How would {label}work across many machines?",
    ),
    "philosophy": (
        "What argument does {label}make?",
        "What does {label}hold about mind and knowledge?",
        "Which moral questions does {label}raise?",
        "Where is the position of {label}weak?",
        "What does {label}add to debates on being and knowing?",
        "How does {label}describe experience?",
        "Which traditions disagree with {label}?",
        "What would {label}change in how one lives?",
    ),
    "biography": (
        "What did the person in {label}achieve?",
        "How did the person in {label}change their field?",
        "Which obstacles does {label}recount?",
        "What legacy does {label}describe?",
        "How did the person's thinking grow in {label}?",
        "How do life and work cross in {label}?",
        "What can be learned from the person in {label}?",
        "Who worked with the person in {label}?",
    ),
    "law": (
        "Which precedent does {label}concern?",
        "How does {label}read the constitution or statutes?",
        "How may {label}guide later rulings?",
        "Which questions of jurisdiction and procedure does {label}raise?",
        "What does {label}mean for policy?",
        "Which civil rights does {label}affect?",
        "Which interests does {label}weigh?",
        "How did the rule in {label}come about?",
    ),
    "economics": (
        "Which market mechanisms does {label}discuss?",
        "Which strategies do the actors in {label}follow?",
        "What do the models in {label}assume?",
        "What should policy take from {label}?",
        "What does {label}say about wealth and who holds it?",
        "How do single choices add up in {label}?",
        "How do small and large scales connect in {label}?",
        "How do people really decide in {label}?",
    ),
    "literature": (
        "Which devices does the narrative of {label}use?",
        "How do themes and symbols carry {label}?",
        "How do the characters of {label}grow?",
        "In what time and culture does {label}stand?",
        "Which genre or movement does {label}belong to?",
        "What does {label}criticise in society?",
        "What does the style of {label}achieve?",
        "How does {label}speak to today's thought?",
    ),
    "psychology": (
        "Which theories of the mind does {label}present?",
        "Which mental processes does {label}explain?",
        "How were the findings of {label}obtained?",
        "How could a clinician use {label}?",
        "What does {label}say about how people develop?",
        "Where does {label}meet brain science?",
        "Which social influences does {label}name?",
        "How does {label}explain differences between people?",
    ),
    "history": (
        "What happened when in {label}?",
        "Which longer patterns do the events of {label}fit?",
        "What caused the events of {label}, and what followed?",
        "Which sources support {label}?",
        "What of {label}still shapes the present?",
        "Who were the main actors of {label}?",
        "Which political and economic forces act in {label}?",
        "Which accepted account does {label}question?",
    ),
    "science_general": (
        "Which methods does {label}use?",
        "What new knowledge does {label}bring?",
        "How were the data of {label}gathered and read?",
        "What follows more widely from {label}?",
        "Which disciplines does {label}join?",
        "Which technologies could come of {label}?",
        "How could others validate {label}?",
        "Which paradigm does {label}extend or dispute?",
    ),
    "astronomy": (
        "Which celestial phenomena does {label}describe?",
        "What does {label}tell of the cosmos?",
        "Which instruments and observations does {label}rely on?",
        "What does {label}imply for how the universe evolved?",
        "How does {label}bear on life elsewhere?",
        "How well do theory and sky agree in {label}?",
        "What does {label}mean for space missions?",
        "Which basic laws of nature does {label}rest on?",
    ),
    "biology": (
        "Which processes of life does {label}describe?",
        "How do genes or ecology enter {label}?",
        "Which laboratory techniques does {label}use?",
        "What does {label}say about evolution?",
        "How might medicine use {label}?",
        "How does form fit function in {label}?",
        "Which surroundings matter in {label}?",
        "What does {label}mean for conservation?",
    ),
    "chemistry": (
        "Which reactions does {label}describe?",
        "How do atoms and bonds explain {label}?",
        "Which procedures and analyses does {label}use?",
        "Which industries could use {label}?",
        "What does {label}add to the making of materials?",
        "What are the energies and rates in {label}?",
        "Which hazards does {label}raise?",
        "What does {label}teach about matter?",
    ),
}
